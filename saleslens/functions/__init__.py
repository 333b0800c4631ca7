from .dates import *  # noqa: F401,F403
from .lunar import *  # noqa: F401,F403
from .numbers import *  # noqa: F401,F403
