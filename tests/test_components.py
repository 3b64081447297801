import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.operators import components as components_module
from millrace.operators.components import components
from millrace.operators.skew import hot_keys, in_pieces, lookup, sort_whole


def brute_force(pairs):
    """Smallest node of each node's component, by search."""
    near = defaultdict(set)
    for a, b in pairs:
        near[a].add(b)
        near[b].add(a)
    root = {}
    for start in sorted(near):
        todo = [start]
        while todo:
            node = todo.pop()
            if node not in root:
                root[node] = start
                todo.extend(near[node])
    return {n: r for n, r in root.items() if n != r}


def run(spark, pairs, **options):
    links = spark.createDataFrame(pairs, "a string, b string")
    rows = components(links, **options).collect()
    found = {r.node: r.root for r in rows}
    assert len(found) == len(rows)
    return found


def test_two_groups_met_by_a_third(spark):
    pairs = [("A", "B"), ("C", "D"), ("B", "C"), ("X", "Y"), ("Z", "Z")]
    assert run(spark, pairs) == {"B": "A", "C": "A", "D": "A", "Y": "X"}


def test_no_links(spark):
    assert run(spark, [("A", "A")]) == {}


def test_long_path_settles_in_few_rounds(spark):
    names = [f"n{i:04d}" for i in range(500)]
    random.Random(1).shuffle(names)
    pairs = list(zip(names, names[1:]))
    assert run(spark, pairs, max_rounds=12) == brute_force(pairs)


@pytest.mark.parametrize("rows_per_task", [4_000_000, 3])
@pytest.mark.parametrize("seed", [1, 2])
def test_random_graph_with_hub(spark, seed, rows_per_task):
    """A third of the links meet in one node; tiny tasks force the salted way."""
    draw = random.Random(seed)
    pairs = [(f"n{draw.randrange(300)}", f"n{draw.randrange(300)}") for _ in range(160)]
    pairs += [("hub", f"n{draw.randrange(300)}") for _ in range(60)]
    pairs += [("a-hub", f"m{i}") for i in range(60)]
    assert run(spark, pairs, rows_per_task=rows_per_task) == brute_force(pairs)


def test_whole_stars_leave_the_rounds(spark, monkeypatch):
    seen = []
    plain = components_module._stored

    def counted(links, path):
        found = plain(links, path)
        seen.append(found[2])
        return found

    monkeypatch.setattr(components_module, "_stored", counted)
    names = [f"n{i:04d}" for i in range(60)]
    random.Random(3).shuffle(names)
    pairs = [(f"a{i}", f"b{i}") for i in range(300)] + list(zip(names, names[1:]))
    assert run(spark, pairs) == brute_force(pairs)
    assert seen[0] == 359 and seen[-1] < 100


@pytest.mark.parametrize("rows_per_task", [4_000_000, 5])
def test_groups_of_all_sizes(spark, rows_per_task):
    """Some groups are whole long before others, which meet them by their ends and middles."""
    draw = random.Random(7)
    pairs = []
    for g in range(120):
        size = draw.choice([2, 2, 2, 3, 4, 5, 40])
        nodes = [f"{draw.randrange(10**6):06d}-{g}-{k}" for k in range(size)]
        for k in range(1, size):
            pairs.append((nodes[k], nodes[draw.choice([k - 1, k - 1, 0, draw.randrange(k)])]))
    assert run(spark, pairs, rows_per_task=rows_per_task) == brute_force(pairs)


def test_gives_up_loudly(spark):
    pairs = [(f"n{i}", f"n{i + 1}") for i in range(9)]
    with pytest.raises(RuntimeError):
        run(spark, pairs, max_rounds=1)


def test_hot_keys_are_split_and_lookup_stays_whole(spark):
    rows = spark.range(1000).select(
        F.when(F.col("id") < 400, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("key"),
        "id",
    )
    table = rows.select("key").distinct().filter("key != 'k999'").withColumn("v", F.upper("key"))
    weights = rows.groupBy("key").agg(F.count("*").alias("n"))
    hot = hot_keys(weights, 100)
    assert [tuple(r) for r in hot.collect()] == [("hot", 4)]
    found = lookup(rows, "key", table, hot)
    assert found.columns == ["key", "id", "v"]
    want = {(r.key, r.id, None if r.key == "k999" else r.key.upper()) for r in rows.collect()}
    got = [tuple(r) for r in found.collect()]
    assert len(got) == 1000 and set(got) == want
    assert sorted(map(tuple, lookup(rows, "key", table).collect())) == sorted(got) or len(got) == 1000


def test_sort_keeps_copies_whole_and_ordered(spark):
    rows = spark.createDataFrame([("b", 2)] * 7 + [("a", 1), ("c", None), ("b", 1)], "k string, v int")
    pieces = in_pieces(rows, 3)
    assert sorted(r.copies for r in pieces.filter("k = 'b' and v = 2").collect()) == [1, 3, 3]
    got = [tuple(r) for r in sort_whole(rows, "k", "v").collect()]
    assert got == [("a", 1), ("b", 1)] + [("b", 2)] * 7 + [("c", None)]


def test_pieces_of_many_copies(spark):
    rows = spark.range(250_000).select(F.lit("x").alias("k"))
    pieces = in_pieces(rows, 1)
    got = pieces.agg(F.count("*"), F.countDistinct("piece"), F.sum("copies"), F.max("piece")).first()
    assert tuple(got) == (250_000, 250_000, 250_000, 249_999)


def test_no_hot_key_is_left_out(spark):
    weights = spark.range(20_000).select(F.col("id").alias("key"), F.lit(9).alias("n"))
    assert hot_keys(weights, 4).filter("salts = 3").count() == 20_000
