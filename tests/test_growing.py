"""State that grows by batches equals what all batches give at once."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

from millrace.operators import growing_groups, growing_series, ledger, movies
from millrace.plans import studies

from .test_ledger import payloads, side, tx


def _line(draw, block):
    def one():
        addrs = draw.sample(range(60), k=draw.choice([1, 1, 1, 2, 2, 3]))
        return tx([side(1, f"a{n:02d}") for n in addrs], [side(1, "x")])

    return [(block, [one() for _ in range(draw.randint(1, 3))])]


def _groups(rows):
    return sorted((r.addr, r.group_addr, r.spends) for r in rows.collect())


def test_groups_grow_to_those_of_all_blocks(spark, tmp_path):
    draw = random.Random(4)
    # Later batches hold earlier blocks, too, so that names change as well as roots.
    lines = [_line(draw, block) for block in draw.sample(range(100), k=30)]
    parts = [lines[:6], lines[6:12], lines[12:13], lines[13:20], lines[20:]]
    for fold in (8, 2):
        place = f"file://{tmp_path}/state-{fold}"
        taken = []
        for n, part in enumerate(parts):
            kept = studies.ledger_rows(payloads(spark, *part))[0]
            # Batches are numbered as their caller likes.
            assert growing_groups.add_transactions(spark, place, kept, batch=10 - n, fold=fold)
            taken += part
            if n in (0, 2, 4):
                whole = ledger.address_groups(studies.ledger_rows(payloads(spark, *taken))[0])
                assert _groups(growing_groups.groups_now(spark, place)) == _groups(whole)
        # A batch that is repeated is not taken again.
        assert not growing_groups.add_transactions(spark, place, kept, batch=6, fold=fold)
        assert _groups(growing_groups.groups_now(spark, place)) == _groups(whole)


def test_a_batch_looks_up_numbers_not_addresses(spark, tmp_path, monkeypatch):
    lines = [[(b, [tx([side(1, f"a{b}"), side(1, f"b{b + k}")], []) for k in range(3)])] for b in range(8)]
    keys = []
    plain = growing_groups.lookup

    def seen(links, key, *more):
        keys.append(dict(links.dtypes)[key])
        return plain(links, key, *more)

    monkeypatch.setattr(growing_groups, "lookup", seen)
    found = []
    for place in (f"file://{tmp_path}/apart", f"file://{tmp_path}/shared"):
        for batch in range(2):
            kept = studies.ledger_rows(payloads(spark, *lines[batch::2]))[0]
            growing_groups.add_transactions(spark, place, kept, batch)
        found.append(_groups(growing_groups.groups_now(spark, place)))
        # Addresses that share a number are looked up as they are.
        monkeypatch.setattr(growing_groups, "node", lambda addr: F.length(addr).cast("bigint"))
    assert keys == ["bigint"] * 4 + ["string"] * 4
    assert found[0] == found[1] == _groups(ledger.address_groups(studies.ledger_rows(payloads(spark, *lines))[0]))


def test_groups_that_no_link_joins_are_not_written(spark, tmp_path):
    place = f"file://{tmp_path}/state"

    def add(batch, *inputs):
        line = [(batch, [tx([side(1, a) for a in addrs], []) for addrs in inputs])]
        kept = studies.ledger_rows(payloads(spark, line))[0]
        return growing_groups.add_transactions(spark, place, kept, batch)

    add(0, "AB", "CD", "EF", "GH")
    add(1, "BC", "E")
    moves = spark.read.parquet(f"{place}/moves/batch-1").collect()
    # The root of C and D moves to that of A and B; E is seen again and stays as it was.
    assert len(moves) == 1
    add(2, "A")
    assert spark.read.parquet(f"{place}/moves/batch-2").count() == 0
    named = defaultdict(set)
    for r in growing_groups.groups_now(spark, place).collect():
        named[r.group_addr].add(r.addr)
    assert named == {"A": set("ABCD"), "E": set("EF"), "G": set("GH")}


def test_a_batch_that_broke_off_is_taken_whole(spark, tmp_path, monkeypatch):
    place = f"file://{tmp_path}/state"
    first = studies.ledger_rows(payloads(spark, [(1, [tx([side(1, "A"), side(1, "B")], [])])]))[0]
    second = studies.ledger_rows(payloads(spark, [(2, [tx([side(1, "B"), side(1, "C")], [])])]))[0]
    growing_groups.add_transactions(spark, place, first, 0)

    def broken(*args, **facts):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(growing_groups.State, "commit", broken)
        try:
            growing_groups.add_transactions(spark, place, second, 1)
        except RuntimeError:
            pass
    assert {r.addr for r in growing_groups.groups_now(spark, place).collect()} == {"A", "B"}
    assert growing_groups.add_transactions(spark, place, second, 1)
    assert _groups(growing_groups.groups_now(spark, place)) == [("A", "A", 1), ("B", "A", 1), ("C", "A", 0)]


# --- Series ---------------------------------------------------------------------------------


def _scores(spark, draw, n):
    rows = [
        (1_700_000_000 + draw.randrange(10**6), f"m{draw.randrange(4)}", draw.randrange(100), 1, draw.randrange(100), 1)
        for _ in range(n)
    ]
    rows += [(1_700_000_000, "once", 5, 1, 5, 1)] if n % 2 else []
    return spark.createDataFrame(
        rows, "ts bigint, name string, critic bigint, numCritic bigint, audience bigint, numAudience bigint"
    )


def _changes(rows):
    return {
        (r.name, r.kind): (r.points, r.minmax, r.slope and round(r.slope * 1e12), r.intercept and round(r.intercept, 3))
        for r in rows.collect()
    }


def test_merged_moments_equal_those_of_all_snapshots(spark, tmp_path):
    draw = random.Random(8)
    place = f"file://{tmp_path}/series"
    every = None
    for shard, n in enumerate((31, 0, 1, 200, 17)):
        part = _scores(spark, draw, n)
        assert growing_series.add_shard(spark, place, part, shard)
        every = part if every is None else every.union(part)
    now = growing_series.changes(growing_series.moments_now(spark, place))
    assert _changes(now) == _changes(movies.score_changes(every))
    assert not growing_series.add_shard(spark, place, part, 4)
    assert _changes(growing_series.changes(growing_series.moments_now(spark, place))) == _changes(now)
    # One time only: no slope.
    assert _changes(now)["once", "critics"][2] is None


def test_times_of_the_clock_cost_no_digits(spark):
    rows = [(1_700_000_000 + k, "m", k, 1, 50 - k, 1) for k in range(40)]
    kinds = "ts bigint, name string, critic bigint, numCritic bigint, audience bigint, numAudience bigint"
    parts = [growing_series.series_moments(spark.createDataFrame(rows[k::3], kinds)) for k in range(3)]
    merged = growing_series.merged(growing_series.merged(parts[0], parts[1]), parts[2])
    slopes = {r.kind: r.slope for r in growing_series.changes(merged).collect()}
    assert abs(slopes["critics"] - 1) < 1e-8 and abs(slopes["audience"] + 1) < 1e-8


def test_nothing_stored_yet(spark, tmp_path):
    assert growing_groups.groups_now(spark, f"file://{tmp_path}/none").collect() == []
    assert growing_series.moments_now(spark, f"file://{tmp_path}/none").filter(F.lit(True)).collect() == []
