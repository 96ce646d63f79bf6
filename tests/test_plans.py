
import contextlib
import io

from pyspark.sql import functions as F

from claimlens.operators import prepare as E
from claimlens.operators.profile import describe_numeric
from claimlens.session import scratch_dir
from claimlens.sources import batches as SB
from claimlens.sources.fixtures import cleaned, policies
from tests.conftest import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_no_python_udf_in_core_operators(spark):
    import __spark_entry__ as entry
    qs = entry.queries()
    for name in ("a5_quality", "a17_drift", "e7_prepare_a", "w1_dedup", "o2_split", "a8_correlations"):
        text = plan(qs[name](spark, SF_SMALL))
        assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text, name


def test_encode_is_broadcast_join(spark):
    c = cleaned(spark, SF_SMALL)
    d = E.fit_dictionary(c, ["MAKE"])
    text = plan(E.encode(c, d, ["MAKE"]))
    assert "BroadcastHashJoin" in text


def test_read_batch_prunes_partitions(spark):
    path = scratch_dir(spark, "plan_batches")
    SB.write_batches(policies(spark, SF_SMALL, with_index=False), path)
    text = plan(SB.read_batch(spark, path, 3))
    assert "PartitionFilters: [isnotnull(batch_id" in text and "(batch_id#" in text


def test_scan_prunes_columns(spark):
    text = plan(cleaned(spark, SF_SMALL).select("batch_id", "PREMIUM").where(F.col("PREMIUM") > 1))
    read_schema = [l for l in text.splitlines() if "ReadSchema" in l][0]
    assert "PREMIUM" in read_schema and "MAKE" not in read_schema
    assert "PushedFilters" in text and "GreaterThan(PREMIUM" in text


def test_profile_exchanges_do_not_grow_with_columns(spark):
    c = cleaned(spark, SF_SMALL)
    n2 = plan(describe_numeric(c, ["PREMIUM", "CCM_TON"])).count("Exchange")
    n4 = plan(describe_numeric(c, ["PREMIUM", "CCM_TON", "SEATS_NUM", "PROD_YEAR"])).count("Exchange")
    assert n2 == n4


def test_row_index_sorts_in_ranges(spark):
    """No window over rows: the only one runs over a row per partition."""
    text = plan(policies(spark, SF_SMALL, stored=False))
    assert "row_number()" not in text
    windows = [x for x in text.splitlines() if x.strip().startswith("Arguments:") and "windowspecdefinition" in x]
    assert all("_part" in x for x in windows)


def test_tree_scoring_moves_no_rows(spark):
    """The raw row goes along through preparation and model, so nothing is joined by row_index."""
    import __spark_entry__ as entry
    text = plan(entry.queries()["m10_predict"](spark, SF_SMALL))
    assert "SortMergeJoin" not in text and "ShuffledHashJoin" not in text
