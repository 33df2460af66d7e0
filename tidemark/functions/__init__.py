from tidemark.functions.columns import *  # noqa: F401,F403
from tidemark.functions.tiers import *  # noqa: F401,F403
