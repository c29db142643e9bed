"""Fingerprints, links and components against brute force; removal of near copies."""

import random

import numpy as np
import pytest

from saleslake.llm import simhash
from saleslake.llm.common import QUERIES, table
from saleslake.llm.components import components

xxhash = pytest.importorskip("xxhash")


def plain_print(text, n=3):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    runs = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(r, seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, tau):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= tau:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(prints))]


def test_query_equals_brute_force(spark, tables):
    docs = sorted((r.doc_id, r.text) for r in table(spark, tables, "documents").collect())
    got = {r.doc_id: r for r in QUERIES["op1_simhash_links"](spark, tables).collect()}
    prints = [plain_print(t) for _, t in docs]
    ids = plain_components(prints, 2)
    for (key, _), number, component in zip(docs, prints, ids, strict=True):
        assert got[key].fingerprint == f"{number:016x}"
        assert got[key].component_id == docs[component][0]


def signed(n):
    return n - (1 << 64) if n >> 63 else n


@pytest.mark.parametrize("tau", [0, 1, 2, 3])
@pytest.mark.parametrize("hot", [2, 64])
def test_links_equal_brute_force(spark, monkeypatch, tau, hot):
    if tau == 3 and hot == 2:
        pytest.skip("the many keys of hot buckets at three bits take long")
    monkeypatch.setattr(simhash, "HOT", hot)
    random.seed(tau)
    numbers = {random.getrandbits(64) for _ in range(60)}
    for _ in range(8):  # crowds around a centre
        centre = random.getrandbits(64)
        for _ in range(12):
            numbers.add(centre ^ sum(1 << b for b in random.sample(range(64), random.randint(0, 4))))
    numbers = sorted(map(signed, numbers))
    df = spark.createDataFrame([(n,) for n in numbers], "p long")
    got = sorted((r.a, r.b) for r in simhash.links(df, tau).collect())
    want = sorted(
        (a, b) for i, a in enumerate(numbers) for b in numbers[i + 1 :] if bin((a ^ b) & (1 << 64) - 1).count("1") <= tau
    )
    assert got == want


def test_proposals_hold_all_links(spark, monkeypatch):
    """With `reach` a crowded bucket may link more, but connects all that the exact join connects."""
    monkeypatch.setattr(simhash, "HOT", 4)
    random.seed(6)
    centre = random.getrandbits(64)
    numbers = {centre ^ sum(1 << b for b in random.sample(range(64), random.randint(0, 3))) for _ in range(60)}
    numbers = sorted(map(signed, numbers | {random.getrandbits(64) for _ in range(40)}))
    df = spark.createDataFrame([(n,) for n in numbers], "p long")
    exact, loose = ({tuple(r) for r in simhash.links(df, 2, reach).collect()} for reach in (None, 10))
    assert all(a < b and bin((a ^ b) & (1 << 64) - 1).count("1") <= 10 for a, b in loose)
    root = {r.node: r.root for r in components(spark.createDataFrame(sorted(loose), "a long, b long")).collect()}
    assert exact and all(root[a] == root[b] for a, b in exact)


def test_reach_only_adds_links(spark, monkeypatch):
    """A pair that is near, one of it within `reach` of the first member of their only bucket and one beyond, is linked."""
    monkeypatch.setattr(simhash, "HOT", 4)
    monkeypatch.setattr(simhash, "bit_order", lambda together, n: list(range(64)))
    monkeypatch.setattr(simhash, "allocation", lambda histograms, n, tau: [(0, 16, 0), (16, 16, 0), (32, 32, 0)])
    random.seed(11)
    numbers = {0}
    for _ in range(30):
        low, high = random.sample(range(16), 6), random.sample(range(16, 32), 5)
        inner = sum(1 << b for b in low[1:] + high[1:])
        numbers |= {inner, inner | 1 << low[0] | 1 << high[0]}
    df = spark.createDataFrame([(n,) for n in sorted(numbers)], "p long")
    exact, loose = ({tuple(r) for r in simhash.links(df, 2, reach).collect()} for reach in (None, 10))
    assert len(exact) >= 30 and exact <= loose


def test_allocation_covers_all_pairs():
    """Thresholds sum to tau - m + 1, so two rows at tau bits are near in some part; costs decide among them."""
    flat = np.ones((8, 256), dtype=np.int64)
    for n in (100, 10**6, 10**9):
        for tau in (0, 2, 3, 5):
            parts = simhash.allocation(flat, n, tau)
            assert parts and sum(t + 1 for _, _, t in parts) == tau + 1
    skewed = flat.copy()
    skewed[:4] = 0
    skewed[:4, 0] = 1  # the first half never differs
    # no part of bits that never differ is probed by itself
    assert all(first + width > 32 for first, width, _ in simhash.allocation(skewed, 10**6, 2))


def test_bits_that_go_together_share_a_chunk():
    together = np.full((64, 64), 250.0)
    np.fill_diagonal(together, 500)
    for a, b in ((3, 40), (7, 61)):
        together[a, b] = together[b, a] = 490
    order = simhash.bit_order(together, 1000)
    assert sorted(order) == list(range(64))
    for a, b in ((3, 40), (7, 61)):
        assert order.index(a) // 8 == order.index(b) // 8


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(100, 130)] + [(1, i) for i in range(2, 60)] + [(500, 500), (300, 299), (300, 299)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = {**{i: 100 for i in range(100, 131)}, **{i: 1 for i in range(1, 60)}, 299: 299, 300: 299}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(5, None, "x"), (3, "", "x"), (4, " \n", "x"), (7, "A b", "x"), (6, "a B", "x"), (6, "a B", "x"), (8, long, "x"), (None, "a b", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, p string")
    got = sorted((r.doc_id or 0, r.component_id, r.p) for r in simhash.clustered(df, "doc_id", 3, 2).collect())
    assert [(k, c) for k, c, _ in got] == [(0, 6), (3, 3), (4, 3), (5, 3), (6, 6), (6, 6), (7, 6), (8, 8)]
    assert got[1][2] == 0
    assert simhash.clustered(df.limit(0), "doc_id", 3, 2).count() == 0


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_near_copies_go_and_others_stay(spark):
    random.seed(8)
    words = [f"w{i}" for i in range(4000)]
    rows, kin = [], {}
    for group in range(12):
        base = [random.choice(words) for _ in range(300)]
        rows.append((group * 100 + 50, " ".join(base)))
        for k in range(12):
            edit = list(base)
            for at in random.sample(range(300), random.choice([1, 2, 4, 30])):
                edit[at] = random.choice(words)
            rows.append((group * 100 + k, " ".join(edit)))
        rows.append((group * 100 + 60, "  " + " ".join(base).upper()))
        kin[group] = base
    rows += [(9000 + i, " ".join(random.choice(words) for _ in range(120))) for i in range(50)]
    rows += [(9900, None), (9901, ""), (9902, " "), (None, rows[0][1])]
    df = spark.createDataFrame([(*r, "en") for r in rows], "doc_id long, text string, shingles string")
    kept = simhash.without_near_copies(df).collect()
    assert kept[0].shingles == "en"
    left = {r.doc_id for r in kept}
    assert {9000 + i for i in range(50)} | {9900, 9901, 9902, None} <= left
    texts = dict(rows)
    missed = 0
    for group in range(12):
        mine = [k for k in texts if k is not None and k // 100 == group and k < 9000]
        gone = [k for k in mine if k not in left]
        stay = [shingles(texts[k]) for k in mine if k in left]
        # whatever goes has a similar text that stays
        for k in gone:
            s = shingles(texts[k])
            assert max(len(s & t) / len(s | t) for t in stay) >= 0.8
        missed += sum(len(a & b) / len(a | b) >= 0.8 for i, a in enumerate(stay) for b in stay[:i])
    assert missed <= 2
    assert simhash.without_near_copies(df.limit(0)).count() == 0


def test_bands_propose_blocks_that_were_added_cut_or_inserted():
    random.seed(21)
    words = [f"w{i}" for i in range(4000)]
    for n in (50, 100, 300):
        missed = pairs = 0
        for _ in range(100):
            base, new = ([random.choice(words) for _ in range(size)] for size in (n, n // 5 - 5))
            for text in (base + new, new + base, base[: n // 2] + new[: n // 8] + base[n // 2 :], base[n // 8 :]):
                a, b = (np.unique(simhash.shingle_hashes(" ".join(t).encode(), 5)) for t in (base, text))
                if len(np.intersect1d(a, b)) >= 0.8 * len(np.union1d(a, b)):
                    pairs += 1
                    missed += not (simhash.band_keys(a) == simhash.band_keys(b)).any()
        assert pairs >= 200 and missed == 0


def test_near_copies_with_a_block_added_or_cut_go(spark):
    random.seed(22)
    words = [f"w{i}" for i in range(4000)]
    rows = []
    for group in range(60):
        n = random.choice([50, 150, 300])
        base, new = ([random.choice(words) for _ in range(size)] for size in (n, n // 8))
        rows.append((group * 10, " ".join(base)))
        rows.append((group * 10 + 1, " ".join([base + new, new + base, base[n // 8 :]][group % 3])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert simhash.without_near_copies(df).count() == 60


def test_pairs_far_from_the_centre_of_their_group_go(spark):
    random.seed(23)
    words = [f"w{i}" for i in range(4000)]
    rows = []
    for group in range(6):
        core = [random.choice(words) for _ in range(85)]
        for k in range(7):  # 0.73 to each other, so in one group
            tail = [random.choice(words) for _ in range(15)]
            rows.append((group * 100 + k, " ".join(core + tail)))
        rows.append((group * 100 + 50, " ".join(core + tail[:-1] + ["other"])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    left = {r.doc_id for r in simhash.without_near_copies(df).collect()}
    for group in range(6):
        assert {group * 100 + k for k in range(6)} <= left
        assert len({group * 100 + 6, group * 100 + 50} & left) == 1


def test_what_stays_does_not_depend_on_the_number_of_pairs(spark, monkeypatch):
    """Rounds only, as few rounds as possible, and the usual mixture keep the same rows."""
    random.seed(24)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for group in range(10):
        base = [random.choice(words) for _ in range(90)]
        for k in range(9):
            edit = list(base)
            for at in random.sample(range(90), random.choice([0, 1, 2, 3, 4, 5])):
                edit[at] = random.choice(words)
            rows.append((group * 100 + k, " ".join(edit + [random.choice(words) for _ in range(random.choice([0, 4, 9]))])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = []
    for paired, shrink in ((0.0, 2.0), (1e9, 0.9), (simhash.PAIRED, simhash.SHRINK)):
        monkeypatch.setattr(simhash, "PAIRED", paired)
        monkeypatch.setattr(simhash, "SHRINK", shrink)
        kept.append(sorted(r.doc_id for r in simhash.without_near_copies(df).collect()))
    assert kept[0] == kept[1] == kept[2] and 10 <= len(kept[0]) < 90


def test_similar_pairs_grow_with_the_rows_of_a_group(spark, monkeypatch):
    """Where the rounds leave a group whole, its rows aren't paired all with all, and what stays is the same."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(4000)}" for _ in range(80)]
    rows = []
    for i in range(300):
        words = list(base)
        for at in rng.sample(range(80), i % 2):
            words[at] = f"x{i}"
        rows.append((i, " ".join([*words, f"y{i}"])))
    rows += [(1000 + i, " ".join(f"w{rng.randrange(4000)}" for _ in range(80))) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    pairs, kept, plain = 0, [], simhash.written

    def counted(frame, label):
        nonlocal pairs
        out = plain(frame, label)
        pairs += out.count() if label in ("near-pairs", "near-edges") else 0
        return out

    monkeypatch.setattr(simhash, "written", counted)
    for paired, step_rows in ((1e9, 16), (1e9, 10**6)):
        monkeypatch.setattr(simhash, "PAIRED", paired)
        monkeypatch.setattr(simhash, "STEP_ROWS", step_rows, raising=False)
        pairs = 0
        kept.append((sorted(r.doc_id for r in simhash.without_near_copies(df).collect()), pairs))
    assert kept[0][0] == kept[1][0] and len(kept[0][0]) < 300
    assert kept[0][1] <= 10 * len(rows)


def test_near_copies_are_proposed_by_linked_fingerprints(spark, monkeypatch):
    """Without any band the join of fingerprints alone finds the copies whose fingerprints it links."""
    monkeypatch.setattr(simhash, "_bands", lambda text: simhash.F.array().cast("array<bigint>"))
    rng = random.Random(5)
    rows, near = [], []
    for i in range(20):
        words = [f"w{rng.randrange(4000)}" for _ in range(300)]
        rows.append((2 * i, " ".join(words)))
        words[150] = "other"
        rows.append((2 * i + 1, " ".join(words)))
        if bin(plain_print(rows[-2][1]) ^ plain_print(rows[-1][1])).count("1") <= 2:
            near.append(i)
    assert near
    left = [r.doc_id for r in simhash.without_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert [i for i in range(20) if sum(d // 2 == i for d in left) == 1] == near
    assert len(left) == 40 - len(near)
