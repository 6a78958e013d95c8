"""Training-data operators (chat linking, mixing, dedup, scoring, classifiers, decontamination, rules).

Nothing outside this subpackage imports it; ``registry`` lists its queries and SQL.
"""
