"""A hot key holding a third of all rows: results stay whole and exact with
AQE skew handling forced on, compared with a direct computation."""

import random

from sluice.operators import status as S

from conftest import rows


def test_hot_process_split_counts_and_details(spark):
    random.seed(7)
    statuses = ["Completed", "FAILED", "In-Progress", None, "error"]
    data = []
    for i in range(6000):
        pid = "hot" if i % 3 == 0 else f"p{i % 500}"
        data.append((i, pid, f"s{i % 7}", statuses[random.randrange(5)], "x", str(i % 11),
                     "timeout" if i % 2 else "", None, None))
    status = spark.createDataFrame(data, "id long, process_id string, sub_process_name string, status string, "
                                         "entity_name string, business_value string, error string, "
                                         "payload_response_id string, notes string")
    splits = spark.createDataFrame([(0, "hot"), (1, "hot")] + [(i + 2, f"p{i}") for i in range(500)],
                                   "position long, split_process_id string")
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = {r["position"]: (r["total_sub_processes"], r["errored"], r["stuck"])
               for r in S.split_results(splits, status).collect()}
        n_details = S.error_details(splits, status, spark.createDataFrame([], "payload_response_id string, response string")).count()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    def direct(pid):
        mine = [d for d in data if d[1] == pid]
        s = [(d[3] or "").strip().upper() for d in mine]
        return (len(mine), sum(x in ("FAILED", "ERROR") for x in s), sum(x not in ("COMPLETED", "FAILED", "ERROR") for x in s))
    assert got[0] == got[1] == direct("hot") and got[0][0] == 2000
    assert all(got[i + 2] == direct(f"p{i}") for i in range(500))
    hot_err = direct("hot")[1]
    assert n_details == 2 * hot_err + sum(direct(f"p{i}")[1] for i in range(500))
