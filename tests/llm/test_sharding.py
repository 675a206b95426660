from collections import Counter

import pytest

from yearloom.llm import sharding


def brute_table(weights, size):
    """Preference lists written out in full; shards claim in turns."""
    names = list(weights)
    prefer = {n: [(sharding._digest(n, "offset") % size + j * (sharding._digest(n, "skip") % (size - 1) + 1)) % size for j in range(size)] for n in names}
    taken = {}
    while len(taken) < size:
        for n in names:
            for _ in range(weights[n]):
                if len(taken) < size:
                    slot = next(s for s in prefer[n] if s not in taken)
                    taken[slot] = n
    return [taken[s] for s in range(size)]


@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 1, "b": 1, "c": 1}, {"a": 3, "b": 1, "c": 2}])
def test_table_is_filled_in_turns(weights):
    names = list(weights)
    assert [names[k] for k in sharding.fill_table(weights, 211)] == brute_table(weights, 211)


def test_balance_and_few_moves():
    shards = [f"s{i}" for i in range(20)]
    counts = Counter(sharding.fill_table(shards, 4099))
    assert max(counts.values()) - min(counts.values()) <= 1
    weighted = Counter(sharding.fill_table({"a": 3, "b": 1}, 4099))
    assert abs(weighted[0] - 3 * weighted[1]) <= 3
    moved = sharding.moved_slots(shards, shards[:-1], 4099)
    assert 4099 / 20 - 1 <= moved <= 0.35 * 4099  # the lost shard's slots, and few others


@pytest.mark.parametrize("bad", [{}, {"a": 0}, []])
def test_bad_shards(bad):
    with pytest.raises(ValueError):
        sharding.fill_table(bad, 211)


def test_size_must_be_prime():
    with pytest.raises(ValueError):
        sharding.fill_table(["a"], 212)


def test_place(spark):
    df = spark.createDataFrame([(1, "x", 9), (1, "y", 9), (None, "z", 9), (2, None, None)], "id long, slot string, Shard int")
    rows = sharding.place(df, "id", ["a", "b", "c"], 211).collect()
    assert len(rows) == 4 and rows[0].__fields__ == ["id", "slot", "shard"]  # clashing columns are replaced
    by = {}
    for r in rows:
        by.setdefault(r.id, set()).add(r.shard)
    assert all(len(v) == 1 for v in by.values())
    table = sharding.fill_table(["a", "b", "c"], 211)
    assert all(r.shard == "abc"[table[r.slot]] for r in rows)
    assert sharding.place(df.limit(0), "id", ["a"], 211).count() == 0


def test_query_places_every_row(spark):
    from yearloom.llm import queries
    out = queries.op7_sharding(spark, "/root/testdata/sf0.001")
    rows = out.collect()
    table, names = sharding.fill_table(queries.SHARDS), list(queries.SHARDS)
    assert len(rows) == 200 and all(names[table[r.slot]] == r.shard for r in rows)
    assert "Shuffle" not in out._jdf.queryExecution().executedPlan().toString()


def test_write_shards(spark, tmp_path):
    df = sharding.place(spark.range(500), "id", ["a", "b", "c"], 211)
    sharding.write_shards(df, str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out").glob("shard=*")) == ["shard=a", "shard=b", "shard=c"]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 500
