"""Literature mining on Spark: documents in, mentions, topics, trends and prices out.

Every operator takes DataFrames and returns a lazy DataFrame.  Lexicons, token
patterns, alias maps, bounds and period widths are inputs (see ``config``).
"""

from papervein.config import Config, TokenPattern, TokenTest

__all__ = ["Config", "TokenPattern", "TokenTest"]
