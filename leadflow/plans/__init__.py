"""End-to-end plans: leads -> applications -> funnel -> reports."""
