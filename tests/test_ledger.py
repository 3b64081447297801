import json
import random

import pytest
from pyspark.sql import functions as F

from millrace import sinks, standins
from millrace.operators import ledger
from millrace.plans import studies


def side(value, addr=None):
    return {"value": value, **({"addr": addr} if addr else {})}


def tx(inputs, out, fee=1):
    return {"fee": fee, "inputs": [{"prev_out": i} for i in inputs], "out": out}


def payloads(spark, *lines):
    rows = [
        (f"u{n}", json.dumps({"blocks": [{"block_index": i, "tx": t} for i, t in line]}))
        for n, line in enumerate(lines)
    ]
    return spark.createDataFrame(rows, "uri string, content string")


def edges(spark, *lines, **options):
    found, groups, _ = studies.ledger_study(payloads(spark, *lines))
    return sorted(map(tuple, found.collect())), {r.addr: r.group_addr for r in groups.collect()}


def test_edges_and_groups(spark):
    line = [
        (10, [
            tx([side(0)], [side(50, "A")], fee=0),
            tx([side(3)], [side(3, "Z")]),
            tx([side(5, "A"), side(6, "B"), side(9)], [side(7, "C"), side(0, "D"), side(2)], fee=4),
        ]),
        (11, [tx([side(0, "C")], [side(1, "A")], fee=None), tx([side(1, "C"), side(1, "A")], [side(2, "E")])]),
    ]
    got, groups = edges(spark, line, [(12, [tx([side(1, "E")], [side(1, "E")])])])
    assert got == [
        (10, 0, "COINBASE", "A", 50, 0),
        (10, 1, "A", "C", 7, 4),
        (11, 3, "A", "E", 2, 1),
        (12, 0, "E", "E", 1, 1),
    ]
    assert groups == {"COINBASE": "COINBASE", "A": "A", "B": "A", "C": "A", "E": "E"}


def test_groups_are_named_after_the_first_seen(spark):
    line = [(1, [tx([side(1, "Z")], []), tx([side(1, "M"), side(1, "B")], []), tx([side(1, "A"), side(1, "B"), side(1, "Z")], [])])]
    _, groups = edges(spark, line)
    assert set(groups.values()) == {"Z"} and len(groups) == 4


def test_inputs(spark):
    line = [(1, [
        tx([side(0)], []), tx([side(0), side(4, "A")], []), tx([side(2, "A"), side(3), side(0, "B")], []), tx([], []),
    ])]
    flat = ledger.flatten_blocks(ledger.parse_payloads(payloads(spark, line)))
    got = {r.tx_pos: (r.addrs, r.value, r.error) for r in ledger.transaction_inputs(flat).collect()}
    assert got == {
        0: (["COINBASE"], 0, None),
        1: (None, None, "Unexpected COINBASE"),
        2: (["A", "B"], 2, None),
        3: ([], 0, None),
    }
    with pytest.raises(Exception, match="Unexpected COINBASE"):
        ledger.transaction_inputs(flat, strict=True).collect()
    parsed = ledger.parse_payloads(payloads(spark, line))
    assert [(r.idx, r.addrs) for r in ledger.kept_transactions(parsed).collect()] == [
        (0, ["COINBASE"]), (1, ["A", "B"]),
    ]
    with pytest.raises(Exception, match="Unexpected COINBASE"):
        ledger.kept_transactions(parsed, strict=True).collect()


def test_damaged_payloads(spark):
    rows = spark.createDataFrame([("u", "{oops"), ("v", '{"blocks": []}'), ("w", None)], "uri string, content string")
    parsed = ledger.parse_payloads(rows)
    assert {r.uri: r.error for r in parsed.collect()} == {
        "u": "not a block payload", "v": None, "w": "not a block payload",
    }
    assert ledger.kept_transactions(parsed).count() == 0


def test_hot_payer_is_spread_without_loss(spark):
    line = [(i, [tx([side(1, "hub"), side(1, f"a{i}")], [side(i + 1, "X")])]) for i in range(50)]
    kept = ledger.kept_transactions(ledger.parse_payloads(payloads(spark, line)))
    kept = studies.stored(kept, "test-kept")
    groups = ledger.address_groups(kept, rows_per_task=4)
    assert {r.group_addr for r in groups.collect()} == {"hub"} and groups.count() == 51
    got = ledger.transaction_edges(kept, groups, rows_per_task=4).collect()
    assert sorted(r.amount for r in got) == list(range(1, 51))
    assert [tuple(r) for r in ledger.group_sizes(groups).collect()] == [("hub", 51)]


def test_written_edges_and_groups(spark, tmp_path):
    found, groups, _ = studies.ledger_study(
        payloads(spark, [(1, [tx([side(2, "A"), side(1, "B")], [side(3, "C")], fee=5)])])
    )
    sinks.write_edges(found, str(tmp_path / "edges"))
    sinks.write_groups(groups, str(tmp_path / "groups"))
    assert [r.value for r in spark.read.text(str(tmp_path / "edges")).collect()] == ["1 0 A C 3 5"]
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "groups")).collect()) == ["A A", "B A"]


def test_failed_rows_leave_the_study(spark):
    line = [(7, [tx([side(0), side(4, "A")], []), tx([side(1, "B")], [side(1, "C")], fee=1)])]
    rows = payloads(spark, line).union(spark.createDataFrame([("bad", "{oops")], "uri string, content string"))
    found, groups, failed = studies.ledger_study(rows)
    assert sorted(map(tuple, failed.fillna("").collect()), key=str) == [
        ("bad", None, "not a block payload"), ("u0", 7, "Unexpected COINBASE"),
    ]
    assert [tuple(r) for r in found.collect()] == [(7, 0, "B", "C", 1, 1)]
    assert [r.addr for r in groups.collect()] == ["B"]


def test_groups_are_aggregated_without_sorting(spark):
    line = [(1, [tx([side(1, "A"), side(1, "B")], [])])]
    kept = ledger.kept_transactions(ledger.parse_payloads(payloads(spark, line)))
    assert "SortAggregate" not in ledger.first_seen(kept)._jdf.queryExecution().toString()


def test_places_keep_their_order(spark):
    draw = random.Random(1)
    top = 2**63 - 1
    places = [(draw.choice([None, 0, 5, top, draw.randrange(top)]), draw.randrange(10**9), draw.randrange(10**9)) for _ in range(300)]
    frame = spark.createDataFrame(places, "b bigint, i bigint, p int")
    packed = [r.x for r in frame.select(ledger._place(F.col("b"), F.col("i"), F.col("p")).alias("x")).collect()]
    order = sorted(range(300), key=lambda n: (-1 if places[n][0] is None else places[n][0], *places[n][1:]))
    assert order == sorted(range(300), key=lambda n: packed[n])


def test_many_members_at_one_first_place_make_no_array(spark, monkeypatch):
    def refused(*_):
        raise AssertionError("gathers a group's members")

    monkeypatch.setattr(ledger.F, "collect_set", refused)
    lines = [[(7, [tx([side(1, f"m{k:02}"), side(1, "z")], [side(1, "Z")])])] for k in range(30)]
    assert set(edges(spark, *lines)[1].values()) == {"m00"}


def test_transactions_are_taken_apart_after_the_explode(spark):
    odd = {"blocks": [
        {"block_index": 1, "tx": [
            None, {"fee": 1, "out": [side(1, "x")]}, tx([], [side(1, "x")]), tx([side(1)], [side(1, "x")]),
            {"fee": 2, "inputs": [None, {"prev_out": None}, {"prev_out": side(None, "A")}]},
            tx([{"value": None}, side(0, "B")], [None, side(0, "x"), side(2, "y"), side(3)], fee=None),
        ]},
        {"block_index": 2},
        {"block_index": None, "tx": [tx([side(0), side(1, "A")], [side(4, "z")], fee=7), tx([side(0)], [])]},
    ]}
    rows = spark.createDataFrame([("u", json.dumps(odd)), ("v", "{oops"), ("w", '{"blocks": []}')], "uri string, content string")
    judged = ledger.judged_transactions(ledger.parse_payloads(rows))
    got = [(r.uri, r.block, r.idx, r.addrs, r.out and [tuple(o) for o in r.out], r.fee, r.error) for r in judged.collect()]
    assert got == [
        ("u", 1, 0, ["A"], None, 2, None),
        ("u", 1, 1, ["B"], [(2, "y")], None, None),
        ("u", None, 2, ["COINBASE"], [], 1, None),
        ("u", None, None, None, [(4, "z")], 7, "Unexpected COINBASE"),
        ("v", None, None, None, None, None, "not a block payload"),
    ]
    plan = judged._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Generate explode" in line and "COINBASE" in line]


def test_links_are_numbered_without_a_lookup(spark, monkeypatch):
    line = [(1, [tx([side(1, f"a{k}"), side(1, f"a{k + 1 + k // 7}")], []) for k in range(30)] + [tx([side(0)], [])])]
    looked = []
    plain = ledger.lookup
    monkeypatch.setattr(ledger, "lookup", lambda rows, key, *more: looked.append(key) or plain(rows, key, *more))
    _, numbered = edges(spark, line)
    assert "first" not in looked and "other" not in looked
    # Addresses that share a number are numbered one by one.
    monkeypatch.setattr(ledger, "node", lambda addr: F.length(addr).cast("bigint"))
    assert edges(spark, line)[1] == numbered and len(numbered) == 35
    assert {"first", "other"} <= set(looked)


def test_rows_of_one_row_group_are_dealt_evenly_however_many_splits_the_file_has(spark, tmp_path):
    place = str(tmp_path / "one")
    spark.range(4000).selectExpr("id", "repeat(cast(id as string), 20) as text").coalesce(1).write.parquet(place)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for key, value in zip(before, ("4k", "1k")):
            spark.conf.set(key, value)
        rows = spark.read.parquet(place)
        # More splits than cores, yet all rows are in one of them.
        assert spark.sparkContext.defaultParallelism <= rows.rdd.getNumPartitions() < 16
        sizes = [r[0] for r in standins.spread(rows).groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sum(sizes) == 4000
    assert max(sizes) <= 2 * 4000 // (4 * spark.sparkContext.defaultParallelism)


def test_a_transaction_does_not_carry_its_whole_block(spark):
    payload = '{"blocks": [{"block_index": 3, "tx": [{"fee": 1, "inputs": [], "out": []}, {"fee": 2, "out": []}]}, {}]}'
    records = spark.createDataFrame([("u", payload), (None, "{}")], "uri string, content string")
    flat = ledger.flatten_blocks(ledger.parse_payloads(records))
    assert [(r.uri, r.block, r.block_pos, r.tx_pos, r.fee) for r in flat.orderBy("tx_pos").collect()] == [
        ("u", 3, 0, 0, 1), ("u", 3, 0, 1, 2)
    ]
    plan = flat._jdf.queryExecution().optimizedPlan().toString()
    exploded = [line for line in plan.split("\n") if "Generate posexplode(" in line][0]
    assert exploded.split("posexplode(")[1].startswith("txs")
