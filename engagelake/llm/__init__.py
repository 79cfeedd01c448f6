"""Training-data operators: ten corpus operators that share this subpackage only.

Nothing outside this folder imports it; ``registry`` lists the queries.
"""
