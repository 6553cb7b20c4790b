"""Column -> Column expressions. Everything here stays on the JVM."""

from docledger.functions.dates import *  # noqa: F401,F403
from docledger.functions.numbers import *  # noqa: F401,F403
from docledger.functions.predicates import *  # noqa: F401,F403
from docledger.functions.strings import *  # noqa: F401,F403
