import heapq
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tillroll.llm import sharding

SF = "/root/testdata/sf0.001"


def one_by_one(groups, shards):
    """Loads after giving the groups, largest first, to the least loaded shard."""
    heap = [(0, j) for j in range(shards)]
    for size in sorted(groups, reverse=True):
        load, j = heap[0]
        heapq.heapreplace(heap, (load + size, j))
    return dict((j, load) for load, j in heap)


@pytest.mark.parametrize("seed", range(6))
def test_placing_sizes_at_once_gives_the_loads_of_single_steps(seed):
    draw = random.Random(seed)
    shards = draw.choice([1, 3, 40])
    groups = [draw.choice([16, 17, 20, 500, 9000, draw.randint(16, 3000)]) for _ in range(draw.choice([0, 5, 4000]))]
    sizes = sorted(Counter(groups).items(), reverse=True)
    placed = sharding.place(np.array([s for s, _ in sizes], np.int64), np.array([n for _, n in sizes], np.int64), shards)
    loads = {j: 0 for j in range(shards)}
    for (size, n), taken in zip(sizes, placed):
        assert sum(taken.values()) == n
        for j, m in taken.items():
            loads[j] += m * size
    assert loads == one_by_one(groups, shards)


def checked(rows, texts, shards):
    """The laws of the result: ``rows`` are (id, size, crc, shard, slot) and ``texts`` the texts of each id."""
    slots, where, loads = defaultdict(list), defaultdict(set), Counter()
    assert Counter(r[0] for r in rows) == Counter({k: len(v) for k, v in texts.items()})
    for key, size, crc, shard, slot in rows:
        slots[shard].append(slot)
        loads[shard] += size
        data = [t.encode() for t in texts[key] if len(t.encode()) + 16 == size and zlib.crc32(t.encode()) == crc]
        assert data
        where[data[0]].add(shard)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(len(v) == 1 for v in where.values())
    groups = Counter()
    for key, own in texts.items():
        for t in own:
            groups[t] += len(t.encode()) + 16
    want = one_by_one(groups.values(), shards)
    assert {j: loads[j] for j in range(shards)} == want


def test_query_against_single_steps(spark):
    rows = sharding.op11_sharding(spark, SF)
    assert rows.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    got = rows.collect()
    assert {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}
    assert {r["shard"] for r in got} <= set(range(40))
    texts = defaultdict(list)
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        texts[r[0]].append(r[1] or "")
    checked([(r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in got], texts, 40)


def test_copies_nulls_ties_repeated_rows_and_clashing_columns(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK_GROUPS", 8)  # several blocks of digests
    data = [(i, "copy of one text") for i in range(60)] + [(100 + i, f"{i:05d}") for i in range(90)]
    data += [(7, "twice"), (7, "twice"), (None, "no id"), (None, None), (300, None), (301, ""), (302, "né" * 5000)]
    clash = "bytes digest block before number ends to shard at split doc size slot count law".split()
    frame = spark.createDataFrame([(*r, *["x"] * len(clash)) for r in data],
                                  "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in clash)).repartition(5)
    texts = defaultdict(list)
    for key, text in data:
        texts[key].append(text or "")
    got = sharding.assign(frame, shards=4).collect()
    checked([tuple(r) for r in got], texts, 4)
    empty = {r["shard"] for r in got if r["size"] == 16}
    assert len(empty) == 1 and {r["text_crc32"] for r in got if r["size"] == 16} == {0}


def test_empty_table(spark):
    assert sharding.assign(spark.createDataFrame([], "doc_id long, text string")).count() == 0
