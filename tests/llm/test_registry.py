import re

import __spark_entry__ as E


def test_every_operator_and_the_pipeline_are_registered():
    queries, sql = E.queries(), E.oracle_sql()
    numbers = sorted(int(re.match(r"op(\d+)_", k)[1]) for k in queries if re.match(r"op\d+_", k))
    assert numbers == list(range(1, 14)) and "pipeline" in queries
    assert {"op2_decontaminate", "op6_substring_dedup", "op9_suffix_dedup", "op13_collocations"} <= set(sql) <= set(queries)
