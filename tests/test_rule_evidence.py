"""Every signature rule matches rows of the probe logs, and not all of them."""

from pyspark.sql import functions as F

from netsift.operators import rules
from netsift.plans import probes
from netsift.plans.catalog import ORACLES, QUERIES, load

SF = "/root/testdata/sf0.001"


def test_every_rule_has_matches_and_misses(spark):
    load()
    found = {r.sid: r.n for r in QUERIES["rule_evidence"](spark, SF).groupBy("sid").agg(F.sum("n").alias("n")).collect()}
    assert set(found) == {r.sid for r in rules.ALL_RULES}
    assert len(found) == 48 and min(found.values()) > 0
    sizes = {name: df.count() for name, df in probes.tables(spark, SF).items()}
    assert all(found[r.sid] < sizes[r.table] for r in rules.ALL_RULES)
    assert {"rule_evidence", "rule_evidence_alerts"} <= ORACLES.keys()
