"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The SQL is written independently of the Spark code path where that is
useful as a cross-check: the player-name parse is the literal token
split/filter/join here and a pair of regular expressions on the Spark side.
"""
