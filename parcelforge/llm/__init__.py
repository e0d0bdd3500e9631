"""Training-data operators.  Nothing outside this subpackage imports it.

Each module holds one operator with a general interface; ``queries`` registers
the thin ``opN_<name>`` queries and ``oracles`` their SQL where SQL can express them.
"""
