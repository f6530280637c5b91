from leadflow.functions.scalars import *  # noqa: F401,F403
from leadflow.functions.scalars import __all__  # noqa: F401
