"""The registered queries on the smallest tables, beside DuckDB where SQL can express them."""

import pytest

from oracle_check import compare, connect
from sceneloom.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
ROWS = {"op3": "pages", "op4": "pages", "op5_spotsigs": "documents", "op6": "documents", "op7": "documents", "op8": "documents", "op9": "documents", "op10": "documents", "op11": "embeddings"}


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    rows = [r.asDict(recursive=True) for r in df.collect()]
    if (t := ROWS.get(name, ROWS.get(name.split("_")[0]))) is not None:
        assert len(rows) == spark.read.parquet(f"{SF}/{t}.parquet").count()
    if name in ORACLE_SQL:
        assert compare(rows, df.columns, connect(SF), ORACLE_SQL[name]) == ""
