"""Registry queries against their SQL where version numbers have more than three digits."""

import duckdb
import pytest

from oracle import TABLES, both
from quern.operators import registry as R
from quern.plans import registered

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def long_numbers(tmp_path_factory):
    """sf0.001 with documents up to version 1,300; the last one of src1 is 999."""
    out = tmp_path_factory.mktemp("sf")
    for t in TABLES:
        if t != "documents":
            (out / f"{t}.parquet").symlink_to(f"{SF}/{t}.parquet")
    duckdb.sql(f"""copy (select * replace (doc_id * 130 as doc_id) from '{SF}/documents.parquet' where source <> 'src1'
        union all select * replace (case when doc_id = (select max(doc_id) from '{SF}/documents.parquet' where source = 'src1') then 19979 else doc_id end as doc_id) from '{SF}/documents.parquet' where source = 'src1')
        to '{out}/documents.parquet' (format parquet)""")
    return str(out)


@pytest.mark.parametrize("name", ["r2_next_versions", "r6_resolve"])
def test_same_rows_above_999(spark, long_numbers, name):
    mine, theirs = both(spark, registered.QUERIES[name], registered.ORACLE_SQL[name], long_numbers)
    assert mine == theirs and mine


def test_the_operator_cuts_no_number(spark):
    reg = spark.createDataFrame([("a", "v999", 1), ("b", "v1000", 1)], "name string, version string, created_at int")
    assert {r.name: r.version for r in R.next_versions(reg).collect()} == {"a": "v1000", "b": "v1001"}
