"""Operations of a training-data pipeline: ten operators over text, vectors and pages.

Nothing else in the library imports this subpackage.  Each operator is a
function from DataFrames to a DataFrame; ``queries`` applies them to the test
tables and holds the SQL that expresses them where SQL can.
"""
