"""The registered queries: test tables bound to surveillance inputs, and their oracle SQL."""
