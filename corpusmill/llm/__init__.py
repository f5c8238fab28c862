"""Operations of a training-data pipeline, one module per operator.

Nothing outside this subpackage imports it.  ``registry`` lists the queries
and the SQL that checks them; ``common`` holds the shared plumbing.
"""
