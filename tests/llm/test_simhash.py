"""Fingerprints against a direct count, components against all pairs."""

import random

import xxhash

from tallyfold.llm import queries, simhash
from tallyfold.llm.common import table

from conftest import SF_SMALL


def brute_fingerprint(text, k=3):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
             .replace("\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(pairs):
    """doc_id -> smallest doc_id reachable over fingerprints of 2 or fewer differing bits."""
    points = sorted({fp for _, fp in pairs})
    root = {p: p for p in points}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(points):
        for b in points[i + 1:]:
            if bin(a ^ b).count("1") <= 2:
                root[find(a)] = find(b)
    least = {}
    for doc, fp in pairs:
        least[find(fp)] = min(doc, least.get(find(fp), doc))
    return {doc: least[find(fp)] for doc, fp in pairs}


def test_fingerprints_of_edge_texts():
    texts = [None, "", " \n\t", "one", "One two", "a b c", "A B C", "é É é É", "a b c d", "x " * 50,
             "w%d " * 3 % (1, 2, 3), " ".join(f"w{i}" for i in range(300))]
    for t in texts:
        assert simhash.fingerprint(t) == brute_fingerprint(t), t


def test_long_texts_are_read_whole_in_runs():
    text = " ".join(f"w{i % 9973}" for i in range(400_000))  # more than one run of a megabyte
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_components_equal_all_pairs(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(12)]
    points = list(base)
    for _ in range(150):  # chains of one and two flipped bits
        points.append(rng.choice(points) ^ (1 << rng.randrange(64)) ^ (rng.random() < 0.5) * (1 << rng.randrange(64)))
    pairs = [(i, rng.choice(points)) for i in range(400)]
    fps = spark.createDataFrame([(simhash._signed(p),) for p in {p for _, p in pairs}], "fp long")
    roots = {r.node: r.root for r in simhash.components(simhash.links(fps)).collect()}
    group = {}
    for doc, p in pairs:
        group.setdefault(roots.get(simhash._signed(p), simhash._signed(p)), []).append(doc)
    got = {doc: min(docs) for docs in group.values() for doc in docs}
    assert got == brute_components(pairs)


def test_a_star_of_many_points_is_one_component(spark):
    centre = 0x0123456789ABCDEF
    around = [centre] + [centre ^ (1 << i) for i in range(64)]
    fps = spark.createDataFrame([(simhash._signed(p),) for p in around], "fp long")
    roots = simhash.components(simhash.links(fps)).collect()
    assert len(roots) == 65 and len({r.root for r in roots}) == 1


def test_query_equals_brute_force(spark):
    got = {r.doc_id: r for r in queries.op3_simhash(spark, SF_SMALL).collect()}
    docs = [(r.doc_id, brute_fingerprint(r.text)) for r in
            table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    want = brute_components(docs)
    assert {d: (r.fingerprint, r.component_id) for d, r in got.items()} == {
        d: (f"{fp:016x}", want[d]) for d, fp in docs}


def test_nulls_repeats_and_dropping(spark):
    docs = spark.createDataFrame(
        [(5, None, "a"), (3, "", "b"), (None, " ", "c"), (7, "alpha beta gamma delta", "d"),
         (7, "alpha beta gamma delta", "d"), (8, "Alpha beta gamma delta", "e")], "doc_id long, text string, fp string")
    got = sorted(((r.doc_id or -1), r.component_id, r.kept) for r in simhash.near_groups(docs).collect())
    assert got == [(-1, 3, False), (3, 3, True), (5, 3, False), (7, 7, False), (7, 7, True), (8, 7, False)]
    left = simhash.drop_near_copies(docs)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [3, 7]
    nothing = docs.limit(0)
    assert simhash.near_groups(nothing).collect() == [] and simhash.drop_near_copies(nothing).collect() == []
