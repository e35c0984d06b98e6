"""DataFrame to DataFrame operators.

Two rules hold throughout. Nothing is grouped before it has been reduced on the map side,
so a key that owns a third of the rows never meets in one task. And statistics go back to
rows through ``joins.skew_join``, whose two sides always end in a shuffle of their own, so
adaptive execution can split a hot key by size.
"""
