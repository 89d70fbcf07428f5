"""Edge cases and brute-force versions of the operators on small tables."""

from __future__ import annotations

import gzip
import hashlib
import math
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidelog.llm import chat, decontam, exact, langid, mainhtml, mixing, quality, simhash, substring, warc
from tidelog.llm.common import WHITE, hash_words, ready, written

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 7))) for _ in range(n))


def documents() -> list[tuple]:
    """Copies, near copies, shared passages, empty, null and very long texts, repeated rows, null ids and sources."""
    base, passage = prose(1, 120), prose(2, 40)
    words = base.split()
    near = " ".join(words[:60] + ["changed"] + words[61:])
    rows = [
        (1, base, "en", "a", 0), (2, base.replace(" ", "\n "), "en", "a", 0), (3, near, "en", "b", 0), (4, None, None, "c", None),
        (5, "", "en", "c", 0), (6, " \t\n", "en", None, 3), (7, f"{prose(3, 30)} {passage} {prose(4, 10)}", "de", "b", 0),
        (8, f"{prose(5, 8)}\u00a0x {passage}", "de", "b", 0), (9, passage, "de", "b", 0), (9, passage, "de", "b", 0),
        (None, base, "en", "a", 0), (None, prose(6, 20), None, None, 0), (10, "er " * 900, "en", "a", 0),
        (11, "É" * 2000 + " one", "fr", "a", 0), (12, prose(7, 30_000), "en", "a", 0), (13, "word", "en", "d", 0),
        (9, prose(8, 25), "de", "b", 0),
    ]
    return rows + [(100 + i, prose(50 + i % 20, 40 + i), "en" if i % 2 else "de", f"s{i % 3}", 1) for i in range(60)]


@pytest.fixture(scope="module")
def docs(spark):
    ready(spark)
    # Extra columns whose names clash with those of results.
    return spark.createDataFrame(documents(), DOC).withColumns(
        {"kept": F.lit("x"), "fingerprint": F.lit(1), "score": F.lit("s"), "copy": F.lit(None).cast("int"), "fp": F.lit(0),
         "a": F.lit(1), "taken": F.lit("t"), "start": F.lit(5), "key": F.lit(1), "size": F.lit("z"), "place": F.lit(0)}
    ).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_exact_marks_against_brute_force(docs):
    groups = defaultdict(list)
    for r in documents():
        groups[re.sub(r"[\x20\x09-\x0D]", "", r[1] or "")].append(r)
    want = []
    for key, rows in groups.items():
        best = min(rows, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        left = True
        for r in sorted(rows, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0)):
            want.append((r[0], best[0], len(rows), left, hashlib.sha256(key.encode()).hexdigest()))
            left = False
    assert got(exact.mark_copies(docs), "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(want, key=repr)


def test_exact_same_with_a_filter_that_is_full(docs):
    small = exact.mark_copies(docs, bits_per_row=1, max_filter_bytes=4096)
    assert got(small, "doc_id", "kept") == got(exact.mark_copies(docs), "doc_id", "kept")


def test_exact_drop_keeps_columns_and_one_row_per_text(docs):
    kept = exact.drop_copies(docs)
    assert kept.columns == docs.columns
    marked = exact.mark_copies(docs).where("kept")
    assert got(kept, "doc_id") == got(marked, "doc_id")


def brute_components(texts: list[str], shingle: int, radius: int):
    prints = [int.from_bytes(simhash.fingerprint((t or "").encode(), shingle, 1), "big") for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return prints, [find(i) for i in range(len(texts))]


def test_fingerprint_is_the_majority_of_shingle_hashes():
    for text in ("", "one", "Ab cD  ef\tgh ij", prose(1, 700), "a b c d a b c d a b"):
        words = WORDS.findall(lower(text))
        shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert int.from_bytes(simhash.fingerprint(text.encode(), 4, 1), "big") == want


@pytest.mark.parametrize("radius,cell", [(4, 4096), (20, 5)])
def test_near_groups_against_brute_force(docs, radius, cell):
    rows = documents()
    prints, roots = brute_components([r[1] for r in rows], 4, radius)
    least = {}
    for r, root in zip(rows, roots):
        ids = [x for x in (least.get(root), r[0]) if x is not None]
        least[root] = min(ids) if ids else None
    want = sorted(((r[0], f"{p:016x}", least[root]) for r, p, root in zip(rows, prints, roots)), key=repr)
    groups = simhash.near_groups(docs, radius=radius, cell=cell)
    assert got(groups, "doc_id", "fingerprint", "component_id") == want


def test_spanning_matches_all_pairs():
    draw = np.random.Generator(np.random.PCG64(1))
    centres = draw.integers(0, 1 << 64, 40, dtype=np.uint64)
    flips = np.bitwise_or.reduce(np.uint64(1) << draw.integers(0, 64, (900, 3), dtype=np.uint64), axis=1)
    points = np.unique(centres[draw.integers(0, 40, 900)] ^ flips)[:, None]
    label = simhash.spanning(points, 4)
    near = np.bitwise_count(points ^ points.T) <= 4
    want = np.arange(len(points))
    while True:
        new = np.array([want[row].min() for row in near])
        if (new == want).all():
            break
        want = new
    assert (label == want).all()


def test_near_copies_one_stays(docs):
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    ids = Counter(r[0] for r in kept.select("doc_id").collect())
    assert ids[1] == 1 and ids[2] == 0 and ids[3] == 0  # copies and near copies of 1
    # The passage under id 9 is four fifths of 8; the other text under 9 stays.
    assert ids[8] == 1 and ids[9] == 1 and ids[12] == 1 and ids[13] == 1
    twice = docs.where("doc_id = 13").unionByName(docs.where("doc_id = 13"))
    assert simhash.drop_near_copies(twice).count() == 1


def test_near_copies_by_similarity(spark):
    rows, want = [], set()
    for g in range(30):
        words = prose(1000 + g, 300).split()
        rows.append((10 * g, " ".join(words)))
        want.add(10 * g)
        for c in range(1, 4):  # up to three words changed: similarity 0.9 and more
            changed = list(words)
            for k in range(c):
                changed[40 * k + 7] = f"new{c}{k}"
            rows.append((10 * g + c, " ".join(changed)))
    kept = simhash.drop_near_copies(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {r[0] for r in kept.collect()} == want


def test_near_copies_are_checked_exactly(spark):
    """Pairs on both sides of the threshold, and a dense group that needs several rounds."""
    rows, want = [], set()
    for g in range(40):
        words = prose(2000 + g, 104).split()  # 100 shingles; a changed word costs five
        rows.append((1000 * g, " ".join(words)))
        want.add(1000 * g)
        for c, at in enumerate(([9], [9, 19], [9, 19, 29])):  # 95/105, 90/110 and 85/115
            rows.append((1000 * g + c + 1, " ".join(f"new{c}{i}" if i in at else w for i, w in enumerate(words))))
    base = prose(9, 400).split()
    for c in range(300):  # changes of one's own: similarity to each other about 0.9
        rows.append((50_000 + c, " ".join(f"own{c}x{i}" if i % 131 == c % 131 else w for i, w in enumerate(base))))
    want.add(50_000)
    sets = {}
    for doc_id, text in rows:
        words = text.split()
        sets[doc_id] = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    for g in range(40):
        alike = [len(sets[1000 * g] & sets[1000 * g + c]) / len(sets[1000 * g] | sets[1000 * g + c]) for c in (1, 2, 3)]
        assert alike[1] >= 0.8 > alike[2]
        want.add(1000 * g + 3)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    kept = {r[0] for r in simhash.drop_near_copies(docs).collect()}
    # Changed documents are alike only through their original: the third has 0.74 of it, 0.7 of the others.
    assert want <= kept and len(kept - want) <= 4


def test_near_copies_none_is_missed(spark):
    """Every pair from 0.8 up is linked, of short texts too, whose fingerprints can be far apart."""
    draw, rows, want = random.Random(17), [], set()
    for g, n in enumerate([5, 6, 9, 10, 13, 14, 18, 24, 30, 44, 60, 104] * 60):  # n - 4 shingles
        words = prose(10_000 + g, n).split()
        kept = n - 4
        other = words + [f"own{g}x{i}" for i in range(math.floor(kept / 0.8 + 1e-9) - kept)]
        rows += [(10 * g, " ".join(words)), (10 * g + 1, " ".join(other))]  # kept / len(other's) >= 0.8, and no more
        want.add(10 * g)
        worse = other + [f"own{g}last"]
        if draw.random() < 0.2 and kept / (len(worse) - 4) < 0.8 and len(other) == n:
            rows.append((10 * g + 2, " ".join(worse)))
            want.add(10 * g + 2)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert {r[0] for r in simhash.drop_near_copies(docs).collect()} == want


def test_common_first_shingles_rule_out_no_similar_pair(spark):
    """All pairs of 150 sets against the filter by lists, where shingles of the same sets are one list."""
    draw = np.random.Generator(np.random.PCG64(21))
    passage = draw.integers(0, 1 << 62, 30).tolist()
    sets = [set(), {7}]
    for _ in range(37):
        base = draw.integers(0, 1 << 62, int(draw.integers(1, 120))).tolist() + (passage if draw.random() < 0.5 else [])
        sets.append(set(base))
        for share in (0.95, 0.82, 0.7):
            keep = [h for h in base if draw.random() < share]
            sets.append(set(keep) | set(draw.integers(0, 1 << 62, int(draw.integers(0, 8))).tolist()))
    hot = np.sort(np.array(passage[:9], dtype=np.uint64))
    rows = []
    for i, one in enumerate(sets):
        hashes = np.sort(np.array(sorted(one), dtype=np.uint64))
        first = simhash._first(hashes, hot, np.arange(len(hot)) + 1, simhash.prefix_length(len(hashes), 0.8))
        rows.append((i.to_bytes(4, "big"), i, len(hashes), first.view(np.int64).tolist()))
    prints = spark.createDataFrame(rows, "fp binary, __set bigint, n int, __first array<bigint>")
    listed = simhash._listed(prints)
    briefs = simhash._briefs(listed, prints.withColumnRenamed("__set", "set"))
    asked = [(rows[a][0], rows[b][0]) for a in range(len(sets)) for b in range(a)]
    found = {
        (int.from_bytes(r[0], "big"), int.from_bytes(r[1], "big"))
        for r in simhash._alike(spark.createDataFrame(asked, "a binary, b binary"), briefs, 0.8).collect()
    }
    overlap = {(a, b): len(sets[a] & sets[b]) for a in range(len(sets)) for b in range(a)}
    similar = {p for p, o in overlap.items() if o and o >= 0.8 * (len(sets[p[0]]) + len(sets[p[1]]) - o)}
    assert len(similar) > 20 and similar <= found
    assert len(found) < sum(o > 0 for o in overlap.values()) / 2
    totals = listed.groupBy("shard").agg(F.max("weight").alias("w"))
    assert totals.count() < totals.agg(F.sum("w")).first()[0]


def test_parities_rule_out_long_sets_with_a_common_passage():
    """Sets of all lengths: similar pairs stay, and of the others nearly none, however long they are."""
    draw = np.random.Generator(np.random.PCG64(9))
    passage = draw.integers(0, 1 << 64, 60, dtype=np.uint64)
    sets = []
    for n in [0, 1, 3, 200, 250, 260, 500, 530, 1000, 1030, 2000, 2040, 2060, 4100] * 3:
        base = np.unique(np.concatenate([draw.integers(0, 1 << 64, n, dtype=np.uint64), passage[: n // 2]]))
        sets += [base, np.unique(np.concatenate([base[len(base) // 10 :], draw.integers(0, 1 << 64, n // 10, dtype=np.uint64)]))]
    prints = [i.to_bytes(32, "big") + i.to_bytes(8, "big") for i in range(len(sets))]
    parities = [simhash._parity(s, simhash._parity_bits(len(s))) for s in sets]
    found, more = simhash._possible(4, 0.8, 0, 1000)(prints, np.arange(len(sets)), [len(s) for s in sets], parities)
    overlap = {(a, b): len(np.intersect1d(sets[a], sets[b])) for a in range(len(sets)) for b in range(a)}
    similar = {p for p, o in overlap.items() if o and o >= 0.8 * (len(sets[p[0]]) + len(sets[p[1]]) - o)}
    assert not more and len(similar) > 30 and similar <= found
    assert sum(min(len(sets[a]), len(sets[b])) > 100 for a, b in found - similar) < 10


def test_wanted_texts_by_broadcast_and_by_filter(spark):
    docs = spark.createDataFrame([(None if i == 5 else i, f"text {i}") for i in range(400)], "doc_id bigint, text string")
    keyed = docs.withColumn(simhash.TEXT_HASH, F.xxhash64("text"))
    wanted = keyed.where("doc_id % 7 = 3 OR doc_id IS NULL").select(
        F.encode("text", "utf-8").alias("__node"), F.col("doc_id").alias("__doc"), F.col(simhash.TEXT_HASH).alias("__hash")
    )
    found = [simhash._wanted_texts(keyed, wanted, most) for most in (1000, 0)]
    texts = [sorted(r.text for r in f.select("__node", "text").collect()) for f in found]
    assert texts[0] == texts[1] and len(texts[0]) == wanted.count() > 50


def test_first_shingles_meet_in_lists():
    draw = np.random.Generator(np.random.PCG64(3))
    for n in [1, 2, 4, 5, 9, 10, 37, 400] * 20:
        a = np.unique(draw.integers(0, 1 << 64, n, dtype=np.uint64))
        b = np.unique(np.concatenate([draw.permutation(a)[: math.ceil(0.8 * n)]]))
        hot = np.sort(draw.permutation(a)[: n // 2])
        first = [simhash._first(x, hot, np.arange(len(hot)) + 1, simhash.prefix_length(len(x), 0.8)) for x in (a, b)]
        assert np.isin(*first).any()
        differ = int.from_bytes(simhash._parity(a), "big") ^ int.from_bytes(simhash._parity(b), "big")
        assert differ.bit_count() <= len(a) - len(b)


def brute_substring(rows):
    first, words = {}, [WORDS.findall(r[1] or "") for r in rows]
    ids = [float("inf") if r[0] is None else r[0] for r in rows]
    for i, w in zip(ids, words):
        for at in range(len(w) - 12):
            key = tuple(w[at : at + 13])
            first[key] = min(first.get(key, i), i)
    out = []
    for r, i, w in zip(rows, ids, words):
        gone = set()
        for at in range(len(w) - 12):
            if first[tuple(w[at : at + 13])] < i:
                gone.update(range(at, at + 13))
        kept = " ".join(x for n, x in enumerate(w) if n not in gone)
        out.append((r[0], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


def test_substring_against_brute_force(docs):
    want = brute_substring(documents())
    columns = ("doc_id", "n_words", "n_removed", "kept_sha256")
    assert got(substring.report(docs), *columns) == sorted((w[:4] for w in want), key=repr)
    kept = substring.remove_repeats(docs)
    assert kept.columns == docs.columns
    assert got(kept, "doc_id", "text") == sorted(((w[0], w[4]) for w in want), key=repr)


def test_substring_hot_anchor_is_spread(spark):
    """A phrase between different words gives one anchor to many different windows; no block holds them all."""
    phrases = [prose(500 + i, 6) for i in range(300)]
    hashes = [substring.hash_grams(hash_words(*plain(p), WHITE)[0], 6, substring.GRAM)[0] for p in phrases]
    phrase = phrases[int(np.argmin(hashes))]
    rows = [(i, f"{prose(7000 + i, 10)} {phrase} {prose(20_000 + i, 10)}") for i in range(2000)]
    rows += [(9000 + i, rows[7 * i][1]) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    options = {"docs_per_block": 50}
    windows = F.sum(F.length("whole")) / substring.EXACT_BYTES
    sizes = [r["n"] for r in substring.indexed(docs, **options).groupBy("block").agg(windows.alias("n")).collect()]
    assert max(sizes) < 3 * sum(sizes) / 41
    found = substring.find_factors(docs, **options).groupBy("doc").agg(F.sum("length").alias("n"))
    assert {r["doc"] for r in found.collect()} == {9000 + i for i in range(50)}
    want = brute_substring(rows)
    columns = ("doc_id", "n_words", "n_removed", "kept_sha256")
    assert got(substring.report(docs), *columns) == sorted((w[:4] for w in want), key=repr)


def plain(text: str) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())])


def brute_decontam(rows, items):
    windows = defaultdict(set)
    for name, text in items:
        w = ALNUM.findall(lower(text or ""))
        size = min(13, len(w))
        for at in range(len(w) - size + 1 if size else 0):
            windows[tuple(w[at : at + size])].add("null" if name is None else str(name))
    out = []
    for r in rows:
        w = ALNUM.findall(lower(r[1] or ""))
        hit, found = set(), set()
        for size in {len(k) for k in windows}:
            for at in range(len(w) - size + 1):
                names = windows.get(tuple(w[at : at + size]))
                if names:
                    hit.update(range(at, at + size))
                    found |= names
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((r[0], len(w), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_words", [2_000_000, 20])
def test_decontamination_against_brute_force(spark, docs, block_words):
    passage = prose(2, 40).split()
    items = [
        (1, " ".join(passage[3:25])), (2, "!".join(passage[:13]).upper()), (3, " ".join(passage[10:14])), (4, "WORD"), (5, None),
        (6, "..."), (10, " ".join(passage[20:40])), (10, prose(1, 20)), (None, "er er"), (11, prose(99, 30)),
    ]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontam.report(docs, bench, block_words=block_words)
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    want = brute_decontam(documents(), items)
    assert got(found, *columns) == want
    kept = decontam.decontaminate(docs, bench, block_words=block_words)
    assert kept.columns == docs.columns
    assert got(kept, "doc_id") == sorted(((w[0],) for w in want if not w[5]), key=repr)


def test_mixing_meets_targets(docs):
    rows = mixing.report(docs).collect()
    sizes, targets, taken = defaultdict(int), {}, defaultdict(int)
    by_id = {(r[0], len(WORDS.findall(r[1] or ""))): r[3] for r in documents()}
    for r in rows:
        source = by_id[r["doc_id"], r["size"]]
        sizes[source] += r["size"]
        targets[source] = r["target"]
        taken[source] += r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    assert len(rows) == len(documents())
    # The contract's procedure: share by weight, stop at the cap, share the excess again.
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    budget, want, free = 1.5 * sum(sizes.values()), {}, set(names)
    while free:
        level = (budget - sum(want.values())) / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 2 * sizes[s]}
        want |= {s: 2 * sizes[s] for s in over} if over else {s: weight[s] * level for s in free}
        free = free - over if over else set()
    for s in names:
        assert targets[s] == pytest.approx(want[s])
        assert abs(taken[s] - want[s]) <= 1


def test_mixing_sequence(docs):
    out = mixing.mix(docs)
    rows = out.collect()
    assert [r["position"] for r in rows] == sorted(r["position"] for r in rows)
    assert all(0 <= r["position"] <= 1 for r in rows)
    total = mixing.report(docs).agg(F.sum("taken")).first()[0]
    assert sum(r["taken"] for r in rows) == total
    assert set(docs.columns) == set(out.columns) - {"position"}


def test_mixing_keeps_sources_of_equal_rows_apart(spark):
    same = [(1, "a b c d", "s1"), (1, "a b c d", "s2"), (1, "a b c d", None), (2, "e f", "s1"), (2, "e f", "s1"), (3, None, "s2")]
    docs = spark.createDataFrame(same, "doc_id bigint, text string, source string")
    rows = mixing.report(docs).collect()
    assert sorted(r["size"] for r in rows) == [0, 2, 2, 4, 4, 4]
    # Untaken documents come first, the others by their first position.
    first = [r["positions"][0] if r["positions"] else -1.0 for r in rows]
    assert first == sorted(first) and all((r["taken"] > 0) == bool(r["positions"]) for r in rows)
    words = Counter()
    for r in mixing.mix(docs).collect():
        words[r["source"]] += r["taken"]
    # Sizes 8, 4, 4 and 24 words to share 3, 1, 2 with the null source last: caps of 16, 8, 8.
    assert words == {"s1": 12, "s2": 4, None: 8}


def test_due_inverts_the_integral(spark):
    grid = spark.range(101).select((F.col("id") / 100).alias("u"))
    for tilt in (0.5, 0.0, -0.5):
        for r in grid.select("u", mixing.due(F.col("u"), F.lit(tilt)).alias("t")).collect():
            assert r["t"] + tilt * (r["t"] - r["t"] ** 2) == pytest.approx(r["u"])


def test_quality_learns_and_scores_everything(spark, small):
    docs, labels = spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/labels.parquet")
    scored = quality.judge(docs, labels)
    found = scored.join(labels, "doc_id").where("held_out").selectExpr("avg(int(predicted = quality))").first()[0]
    assert scored.count() == docs.count() and found > 0.8
    assert got(scored, "doc_id", "score") == got(quality.judge(docs.repartition(5), labels), "doc_id", "score")


def test_quality_edges(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1), (2, 1), (10, 0), (None, 0), (7, None), (999, 1)], "doc_id bigint, quality int")
    scored = quality.judge(docs, labels)
    assert scored.count() == len(documents()) and scored.where("score between 0 and 1").count() == len(documents())
    assert quality.judge(docs, labels.limit(0)).where("score = 0.5").count() == len(documents())
    assert quality.keep_good(docs, labels).columns == docs.columns
    assert quality.judge(empty, labels).count() == 0


def test_language_edges(spark, docs, empty):
    found = {(r["doc_id"], r["lang_pred"]): r for r in langid.identify(docs).collect()}
    assert {k for k in found if k[0] in (4, 5, 6)} == {(4, "und"), (5, "und"), (6, "und")}
    assert {k[1] for k in found} <= {"en", "de", "fr", "und"}
    assert langid.identify(empty).count() == 0
    nothing = langid.identify(docs.withColumn("lang", F.lit(None).cast("string")))
    assert [r[0] for r in nothing.select("lang_pred").distinct().collect()] == ["und"]


def test_language_held_out_accuracy(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    found = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert found.selectExpr("avg(int(lang_pred = lang))").first()[0] > 0.95


def test_presence_counts_each_gram_once():
    text = "abab".encode()
    data, cuts = np.frombuffer(text, np.uint8), np.array([0, 4])
    assert np.count_nonzero(langid.presence(data, cuts)) <= 2 + 2 + 2 + 1
    pieces = langid.PIECE
    try:
        langid.PIECE = 7
        long = np.frombuffer(prose(1, 40).encode(), np.uint8)
        small_pieces = langid.presence(long, np.array([0, 50, len(long)]))
    finally:
        langid.PIECE = pieces
    assert (small_pieces == langid.presence(long, np.array([0, 50, len(long)]))).all()


def test_words_hash_alike_in_any_piece():
    from tidelog.llm import common

    texts = [prose(1, 50), "", "x" * 300, " lead", prose(1, 50)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    cuts = np.cumsum([0, *map(len, texts)])
    whole, rows = hash_words(data, cuts, WHITE)
    size = common.PIECE
    try:
        common.PIECE = 64
        pieces, again = hash_words(data, cuts, WHITE)
    finally:
        common.PIECE = size
    assert (whole == pieces).all() and (rows == again).all()
    assert np.diff(rows).tolist() == [len(t.split()) for t in texts]
    assert (whole[:50] == whole[-50:]).all()


def test_language_sample_is_bounded_where_an_id_repeats(spark, monkeypatch):
    kept = {}

    def keep(df, label):
        kept[label] = written(df, label)
        return kept[label]

    monkeypatch.setattr(langid, "written", keep)
    data = [(1, prose(n, 20), "abc"[n % 3], "s", 0) for n in range(400)]
    model = langid.train(spark.createDataFrame(data, DOC), max_rows=50, landmarks=12)
    assert kept["sample"].count() == 50 and model is not None


def test_loss_is_read_through_the_mask(spark):
    rows = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "good day")], "conv_id bigint, turn bigint, role string, text string")
    formatted = chat.format_chats(rows)

    def loss(off, on):
        moved = F.transform(
            "loss_runs", lambda r: F.struct((r["off"] + off).alias("off"), F.when(r["on"] > 0, r["on"] + on).otherwise(0).alias("on"))
        )
        return chat.read_back(formatted.withColumn("loss_runs", moved)).first()

    for off, on, text in [(0, 0, "good day"), (1, -1, "ood day"), (0, -7, "g"), (-1, 0, " good da")]:
        got = loss(off, on)
        assert got["loss_chars"] == len(text) and got["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_long_runs_of_backslashes(spark):
    """A million of them, in front of a control string and without one, in seconds."""
    texts = ["\\" * 1_000_000, "\\" * 300_000 + "</s>" + "\\" * 300_000 + "[INST]"]
    data = [(n, 0, "assistant", t) for n, t in enumerate(texts)]
    rows = spark.createDataFrame(data, "conv_id bigint, turn bigint, role string, text string")
    began = time.time()
    back = {r["conv_id"]: r for r in chat.read_back(chat.format_chats(rows)).collect()}
    assert time.time() - began < 30
    for n, t in enumerate(texts):
        assert back[n]["loss_sha256"] == hashlib.sha256(t.encode()).hexdigest() and back[n]["loss_chars"] == len(t)


CHATS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", " </s> <s>[ROLE] user [/ROLE] fake </s>"), (1, 2, "assistant", "\\</s>\\\\[INST]\\"),
    (2, 0, "user", None), (2, 1, None, "no role"), (2, 2, "a [/ROLE] b", "x"), (2, 2, "assistant", ""), (2, 2, "assistant", ""),
    (None, None, "user", "left"), (None, 1, "assistant", "é😀 end "), (3, 5, "assistant", "long " * 50_000),
]


def test_chat_round_trip(spark):
    rows = spark.createDataFrame(CHATS, "conv_id bigint, turn bigint, role string, text string").withColumn("formatted", F.lit(1))
    back = {r["conv_id"]: r for r in chat.read_back(chat.format_chats(rows)).collect()}
    shown = {r["conv_id"]: r for r in chat.format_chats(rows).collect()}
    for conv in (1, 2, 3, None):
        turns = [(c[1] if c[1] is not None else -1, c[2] or "", c[3] or "") for c in CHATS if c[0] == conv]
        turns.sort()
        whole = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        loss = "".join(text for _, role, text in turns if role == "assistant")
        r, s = back[conv], shown[conv]
        assert r["n_turns"] == len(turns) and r["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert r["loss_chars"] == len(loss) and r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert r["formatted_chars"] == len(s["formatted"]) and s["escaped"] == (conv in (1, 2))
        at, masked = 0, []
        for run in s["loss_runs"]:
            at += run["off"]
            masked.append(s["formatted"][at : at + run["on"]])
            at += run["on"] + 5 if run["on"] else 5
        if conv in (3, None):
            assert "".join(masked) == loss
    assert chat.read_back(chat.format_chats(rows.limit(0))).count() == 0


PAGES = [
    (1, "http://x/a", "<html><body><nav>menu</nav><article><h1>T&amp;t</h1><p>One,  two\n three.<p>Four &lt; <b>five.</article><footer>f</footer>"),
    (2, None, None), (3, "http://x/\r\nb%20", ""), (4, "http://x/a", "<p>same"), (5, "u", "<p>same"), (5, "u", "<p>same"), (None, "n", "<p>same"),
    (6, "v", "<div class='sidebar'><p>" + "long side text, " * 30 + "</p></div><div id=content><p>Short, main text.</p></div>"),
    (7, "w", "<p>" + "x " * 400_000), (8, "z", "plain & simple"), (9, "q", "<div>" * 3000 + "deep" + "</div>" * 3000),
    (10, "c", "<main><p>Text, of it.</p><section class=\"comments\"><p>reader, says, things, here</p></section><script>if(a<b){}</script></main>"),
]


def test_html(spark):
    rows = spark.createDataFrame(PAGES, "page_id bigint, url string, html string").withColumn("text", F.lit(0))
    found = {r["page_id"]: r["text"] for r in mainhtml.report(rows).collect()}
    assert found[1] == "T&t\nOne, two three.\nFour < five."
    assert found[2] == "" and found[3] == "" and found[4] == "same"
    assert found[6] == "Short, main text." and found[8] == "plain & simple" and found[9] == "deep"
    assert found[10] == "Text, of it."
    assert len(found[7]) == 799_999
    assert mainhtml.report(rows.limit(0)).count() == 0


def test_html_main_text_of_given_pages(spark, small):
    """The pages are articles between a menu, an advert and a footer: compare with what stands inside."""
    import html as decoder

    rows = spark.read.parquet(f"{small}/pages.parquet")
    found = {r["page_id"]: r["text"] for r in mainhtml.report(rows).collect()}
    for r in rows.collect():
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", r["html"], re.S).group(1)
        blocks = re.split(r"</?(?:p|h1)>", inner)
        lines = [" ".join(decoder.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in blocks]
        assert found[r["page_id"]] == "\n".join(x for x in lines if x)


@pytest.mark.parametrize("range_bytes", [97, 1 << 20])
def test_warc_round_trip(spark, range_bytes):
    rows = spark.createDataFrame(PAGES, "page_id bigint, url string, html string").withColumn("payload", F.lit(0))
    archives = warc.write_archives(ready(spark), rows)
    back = warc.read_archives(archives, range_bytes).collect()
    want = []
    for page_id, url, body in PAGES:
        payload = (body or "").encode()
        same = [p[0] for p in PAGES if (p[2] or "") == (body or "")]
        first = min((i for i in same if i is not None), default=None)
        other = page_id != first
        want.append((page_id, url or "", b"" if other else payload, len(payload), warc.base32_sha1(payload), "revisit" if other else "response", first if other else None))
    assert sorted((tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in back), key=repr) == sorted(want, key=repr)
    assert sum(r["records"] for r in archives.collect()) == len(PAGES)


def test_warc_payload_is_verified():
    payload = b"<p>some text</p>"
    digest = warc.base32_sha1(payload)
    whole = gzip.decompress(warc.record(1, "u", payload, digest, None, False))
    assert warc.parse_record(whole)[2:5] == (payload, len(payload), digest)
    altered = whole.replace(b"some text", b"same text")
    cut = whole.replace(payload, payload[:-4])
    for content in (altered, cut):
        with pytest.raises(ValueError, match="payload"):
            warc.parse_record(content)
    seen = gzip.decompress(warc.record(2, "u", payload, digest, 1, True))
    assert warc.parse_record(seen)[2:5] == (b"", len(payload), digest)


def test_warc_decoys_and_empty(spark):
    """Gzip magic and even whole gzip members inside a payload are not records."""
    import io
    import zlib

    inner = zlib.compress(b"not a record", 0, 31) + b"\x1f\x8b\x08\x00junk"
    record = warc.record(1, "u", inner, warc.base32_sha1(inner), None, False)
    stored = zlib.compressobj(0, zlib.DEFLATED, 31)
    content = zlib.decompress(record, 31)
    member = stored.compress(content) + stored.flush()
    archive = member + record + member
    found = [c for begin in range(0, len(archive), 50) for c in warc.members(io.BytesIO(archive), begin, begin + 50)]
    assert found == [content] * 3
    empty = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert warc.archive_report(empty).count() == 0


def test_empty_tables(spark, empty):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert exact.mark_copies(empty).count() == 0 and exact.drop_copies(empty).count() == 0
    assert simhash.near_groups(empty).count() == 0 and simhash.drop_near_copies(empty).count() == 0
    assert substring.report(empty).count() == 0
    assert decontam.report(empty, bench).count() == 0
    assert mixing.report(empty).count() == 0 and mixing.mix(empty).count() == 0


def test_html_other_layouts():
    body = "A sentence with, some commas, and enough words for a paragraph. " * 4
    page = (
        "<body><div id=header><a href=/>Home</a></div><div class=menu><ul><li><a href=a>A</a></ul></div><div class=content>"
        f"<h1>Title</h1><div class=sec><p>{body}</p></div><h2>Sub</h2><div class=sec><p>{body}</p><ul><li>one</ul></div></div>"
        f"<div id=sidebar><p>{body}</p></div><div class='cookie-notice'>{body}</div><section id=comments><p>{body}</p></section></body>"
    )
    assert mainhtml.main_text(page).split("\n") == ["Title", body.strip(), "Sub", body.strip(), "one"]
    assert mainhtml.main_text(f"<p title='a > b'>{body}<span class=ad>buy</span> end</p><p hidden>no</p>") == f"{body}end"
    assert mainhtml.main_text(f"<aside>{body}</aside><article><header><h1>T</h1></header><p>Yes.</article>") == "T\nYes."
