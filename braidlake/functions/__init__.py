"""Column functions. Every one compiles to built-in expressions and never raises on dirty input."""

from braidlake.functions.casts import *  # noqa: F401,F403
from braidlake.functions.dates import *  # noqa: F401,F403
from braidlake.functions.keys import *  # noqa: F401,F403
from braidlake.functions.text import *  # noqa: F401,F403
