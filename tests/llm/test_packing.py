import random
import struct
import zlib

import pytest

from poiloom.llm import packing
from poiloom.llm.config_lp import best_fit, knapsack, pack, solve
from poiloom.llm.queries import tokenizer_path


@pytest.mark.parametrize("capacity", [64, 4096])
def test_pieces_and_sequences(spark, docs, rows, capacity):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    got = packing.pack_documents(docs, tokenizer_path(), capacity).collect()
    ids = {r[0]: [*t.encode(r[1] or "", add_special_tokens=False).ids, 1] for r in rows}
    assert len(got) == sum(-(-len(x) // capacity) for x in ids.values())
    sequences: dict = {}
    for r in got:
        part = ids[r.doc_id][r.start : r.start + capacity]
        assert r.start == r.piece * capacity and r.length == len(part)
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= capacity
    bound = -(-sum(map(len, ids.values())) // capacity)
    histogram: dict = {}
    for r in got:
        histogram[r.length] = histogram.get(r.length, 0) + 1
    assert bound <= len(sequences) <= len(best_fit(histogram, capacity))


def test_words_equal_whole_texts():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    ids = packing.WordIds(tokenizer_path())
    assert ids.direct
    for text in ["It's Ünïcode— don't x3 a1b2 <|endoftext|> y", "İstanbul ΣΑΣ ñ.. (über) ×÷", "é a b c\x1cd", "ﬁ ½ ǅ 你好 🙂🙂", "a_b-c/d'll"]:
        raw = b"".join(map(ids.__getitem__, text.encode().split()))
        assert list(struct.unpack(f"<{len(raw) // 4}I", raw)) == t.encode(text, add_special_tokens=False).ids


def test_empty_table(spark, empty):
    assert packing.pack_documents(empty, tokenizer_path()).count() == 0


def test_repeated_rows(spark, docs):
    d = docs.limit(5)
    assert packing.pack_documents(d.unionAll(d), tokenizer_path()).count() == 2 * packing.pack_documents(d, tokenizer_path()).count()


def test_plan_places_all():
    rng = random.Random(2)
    for _ in range(20):
        capacity = rng.choice([10, 50, 200])
        counts = {rng.randint(1, capacity): rng.randint(1, 30) for _ in range(rng.randint(1, 12))}
        plan = pack(counts, capacity)
        placed: dict = {}
        for k, parts in zip(plan.times, plan.contents, strict=True):
            assert sum(x * n for x, n in parts) <= capacity
            for x, n in parts:
                placed[x] = placed.get(x, 0) + n * k
        assert placed == counts
        assert sum(k * n for k, n in counts.items()) <= plan.lower_bound * capacity + 1e-6
        assert plan.lower_bound <= plan.lp_value + 1e-6 <= plan.bins() + 1e-5
        assert plan.bins() <= len(best_fit(counts, capacity))


def fewest(counts: dict, capacity: int) -> int:
    """The least number of bins, by trying all."""
    from functools import cache

    lengths = sorted(counts, reverse=True)

    @cache
    def bins(left: tuple) -> int:
        if not any(left):
            return 0
        first = next(i for i, n in enumerate(left) if n)
        found = sum(left)

        def fill(i: int, room: int, rest: tuple) -> None:
            nonlocal found
            if i == len(lengths):
                found = min(found, 1 + bins(rest))
                return
            for n in range(min(rest[i], room // lengths[i]) + 1):
                fill(i + 1, room - n * lengths[i], (*rest[:i], rest[i] - n, *rest[i + 1 :]))

        rest = (*left[:first], left[first] - 1, *left[first + 1 :])
        fill(first, capacity - lengths[first], rest)
        return found

    return bins(tuple(counts[x] for x in lengths))


def test_optimum_of_small_cases():
    rng = random.Random(5)
    for _ in range(60):
        capacity = rng.choice([10, 17, 30])
        counts = {k: rng.randint(1, 3) for k in rng.sample(range(2, capacity), rng.randint(1, 4))}
        plan, least = pack(counts, capacity), fewest(counts, capacity)
        assert plan.lower_bound <= least + 1e-6 and plan.bins() == least, counts


def test_hard_histograms():
    # bins that only some mixtures fill; documents' lengths, many of them once
    rng = random.Random(3)
    pareto = {}
    for _ in range(20000):
        k = min(4096, int(30 * rng.paretovariate(0.7)))
        pareto[k] = pareto.get(k, 0) + 1
    for counts in ({2100: 500, 1300: 700, 900: 300}, {2100: 500}, {1366: 1000, 1364: 500, 2049: 300}, pareto):
        plan = pack(counts, 4096)
        assert plan.lower_bound <= plan.lp_value <= plan.bins() <= len(best_fit(counts, 4096))
        assert plan.bins() <= 1.01 * plan.lower_bound + 1


def test_knapsack_and_cover():
    import numpy as np

    lengths = np.array([3, 5, 7])
    best = knapsack(np.array([1.0, 2.0, 3.1]), lengths, 15)
    assert best[15] == pytest.approx(6.2) and best[2] == 0 and best[10] == pytest.approx(4.1)
    amounts, bound, _ = solve({3: 4, 5: 6, 7: 2}, 15)
    assert bound <= sum(amounts.values()) and all(sum(c) <= 15 for c in amounts)
    for x, n in {3: 4, 5: 6, 7: 2}.items():
        assert sum(a * c.count(x) for c, a in amounts.items()) == n
