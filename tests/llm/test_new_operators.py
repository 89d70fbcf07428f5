"""Whitening, token files and divergence against brute force, with edge cases."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidelog.llm import divergence, tokenfiles, warc, whitening
from tidelog.llm.common import ready

DOC = "doc_id bigint, text string, lang string, source string"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def prose(seed: int, n: int, letters: str = "abcdefgh") -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice(letters) for _ in range(draw.randint(1, 4))) for _ in range(n))


# --- whitening


def vectors(n: int = 300, width: int = 12) -> list[tuple]:
    draw = np.random.default_rng(5)
    mixed = draw.normal(size=(n, width)) @ draw.normal(size=(width, width)) * 0.2
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(mixed)]
    bad = [
        (1000, None), (1001, [0.1] * (width - 1) + [None]), (1002, [math.nan] * width), (1003, [math.inf] + [0.0] * (width - 1)),
        (1004, []), (1005, [1e300] * width), (None, rows[3][1]), (5, rows[5][1]),
    ]
    return rows + bad + [(2000 + i, rows[7][1]) for i in range(150)]


def expected(rows: list[tuple], width: int) -> tuple[dict, np.ndarray, np.ndarray]:
    kept = [
        (i, [math.floor(c * 1024) + 100000 for c in v])
        for i, v in rows
        if v and len(v) == width and all(c is not None and math.isfinite(c) and abs(c) < 1e15 for c in v)
    ]
    n, sums = len(kept), [sum(v[j] for _, v in kept) for j in range(width)]
    x = np.array([[n * c - s for c, s in zip(v, sums)] for _, v in kept], dtype=float) / n
    values, directions = np.linalg.eigh(x.T @ x / n)
    deviation = [(i, sum((n * c - s) ** 2 for c, s in zip(v, sums))) for i, v in kept]
    return deviation, x @ directions[:, ::-1][:, :8] / np.sqrt(values[::-1][:8]), values[::-1] / values.sum()


def test_whitening_equals_brute_force(spark):
    rows = vectors()
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(5)
    table = table.withColumns({"n": F.lit("x"), "v": F.lit(1), "width": F.lit(2), "component": F.lit(9)})
    got = whitening.report(table).collect()
    deviation, white, explained = expected(rows, 12)
    assert len(got) == 8 * len(deviation) and {r.n for r in got} == {len(deviation)}
    assert Counter((r.vec_id, r.deviation) for r in got if r.component == 1) == Counter(deviation)
    assert all(str(r.deviation) == r.deviation_text for r in got)
    assert {r.identity_error for r in got}.pop() < 1e-9
    by_row = defaultdict(dict)
    for r in got:
        by_row[r.vec_id, r.deviation][r.component] = r.whitened
        assert abs(r.explained - explained[r.component - 1]) < 1e-9
    want = {k: w for k, w in zip(deviation, white)}
    signs = [np.sign(by_row[deviation[0]][c + 1] * white[0][c]) for c in range(8)]
    for key, found in by_row.items():
        assert np.allclose([found[c + 1] * signs[c] for c in range(8)], want[key], atol=1e-9)


@pytest.mark.parametrize("low, high", [(-50, 900), (-(2**40), 2**41), (-(2**63), 2**63 - 1), (7, 7)])
def test_scatter_is_exact(low, high):
    draw = random.Random(low)
    x = [[draw.randint(low, high) for _ in range(5)] for _ in range(131)]
    sums, cross = whitening.scatter(np.array(x, dtype=np.int64))
    assert [int(s) for s in sums] == [sum(r[j] for r in x) for j in range(5)]
    for j in range(5):
        for k in range(j, 5):
            assert int(cross[j, k]) == sum(r[j] * r[k] for r in x)


def test_deviations_beyond_a_long(spark):
    rows = [(i, [float(i % 7) * 2.0**40, 1.0 + i]) for i in range(50)]
    got = whitening.report(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    exact = {i: sum((50 * c - s) ** 2 for c, s in zip(v, s2)) for s2 in [[sum(math.floor(r[1][j] * 1024) + 100000 for r in rows) for j in (0, 1)]]
             for i, v in ((i, [math.floor(c * 1024) + 100000 for c in v]) for i, v in rows)}
    assert got and all(int(r.deviation_text) == exact[r.vec_id] for r in got)
    assert all(r.deviation == (exact[r.vec_id] if exact[r.vec_id] < 2**63 else None) for r in got)


def test_whitening_of_other_tables(spark):
    kind = "vec_id bigint, embedding array<float>"
    assert whitening.report(spark.createDataFrame([], kind)).count() == 0
    equal = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], kind)
    assert whitening.report(equal).count() == 0  # no direction in which they differ
    two = spark.createDataFrame([(i, [float(i), float(i * i)][: 1 + i % 2]) for i in range(12)], kind)
    got = whitening.report(two).collect()
    assert Counter(r.n for r in got) == {6: 6 + 12}  # one component for width 1, two for width 2


# --- token files


def texts() -> list[tuple]:
    rows = [
        (7, None), (8, ""), (9, " \n\n  x"), (None, "no id"), (None, None), (3, "a b"), (3, "a b"), (3, "c"),
        (11, prose(1, 60_000)), (12, "é ü’s  <|endoftext|> ​ 漢字 " * 40), (13, "x" * 5000), (-5, "minus one"),
    ]
    return rows + [(100 + i, prose(i, i % 50)) for i in range(300)] + [(500, "hot " * 5)] * 150


def test_token_files_equal_brute_force(spark):
    ready(spark)
    rows = texts()
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    table = table.withColumns({"path": F.lit(1), "tie": F.lit("x"), "start": F.lit(0), "part": F.lit("p")})
    files = tokenfiles.write_files(table, TOKENIZER, range_bytes=20_000, file_ids=3000, block=512)
    assert files.count() > 4
    got = tokenfiles.read_documents(files).collect()
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.encode_special_tokens = True
    ids = [tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for _, t in rows]
    want = Counter((d, len(i), zlib.crc32(np.array(i, dtype="<u4").tobytes())) for (d, _), i in zip(rows, ids))
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    got.sort(key=lambda r: r.start)
    assert [r.start for r in got] == list(np.cumsum([0] + [r.n_tokens for r in got[:-1]]))
    order = [math.inf if r.doc_id is None else r.doc_id for r in got]
    assert order == sorted(order)


@pytest.mark.parametrize("unit", [1, 8])
def test_planes_round_trip_and_random_reads(tmp_path, unit):
    draw = np.random.default_rng(unit)
    streams = [draw.integers(0, top, size, dtype=np.uint64).astype(np.uint32) for top, size in ((1, 9), (50257, 5001), (2**32, 777))]
    store, path = pafs.LocalFileSystem(), str(tmp_path / "x.ids")
    writer = tokenfiles.IdWriter(store.open_output_stream(path), unit, 256)
    for i, ids in enumerate(streams):
        writer.add(tokenfiles.IDS, ids)
        writer.add(tokenfiles.DOCS, np.array([i - 1]).view(np.uint64))
        writer.add(tokenfiles.LENGTHS, np.array([len(ids) << 1], dtype=np.uint64))
    assert writer.close() == (tmp_path / "x.ids").stat().st_size
    with store.open_input_file(path) as file:
        found = [(d, n, np.concatenate(list(p))) for d, n, p in tokenfiles.IdFile(file).documents()]
        assert [d for d, _, _ in found] == [-1, 0, 1] and all(np.array_equal(f[2], s) for f, s in zip(found, streams))
        whole = np.concatenate(streams)
        for begin, end in ((0, 0), (0, 1), (255, 257), (100, 5000), (5700, 99999)):
            assert np.array_equal(tokenfiles.IdFile(file).ids(begin, end), whole[begin:end])
    data = bytearray((tmp_path / "x.ids").read_bytes())
    data[20] ^= 1
    (tmp_path / "y.ids").write_bytes(data)
    with store.open_input_file(str(tmp_path / "y.ids")) as file, pytest.raises(Exception):
        list(tokenfiles.IdFile(file).stream(tokenfiles.IDS))


def test_pieces_give_the_ids_of_whole_texts():
    with open(TOKENIZER, encoding="utf-8") as file:
        encoder = tokenfiles.Encoder(file.read(), memory=500)
    draw = random.Random(4)
    some = ["".join(draw.choice("ab1 \n\n  .,'s!_é　́\t\r'᠎​ж²") for _ in range(draw.randint(0, 14))) for _ in range(4000)]
    assert encoder.by_piece
    for begin in range(0, 4000, 400):
        part = some[begin : begin + 400]
        ids, sizes = encoder.encode(part)
        want = encoder.tokenizer.encode_batch(part, add_special_tokens=False)
        assert list(sizes) == [len(w.ids) for w in want] and list(ids) == [i for w in want for i in w.ids]


def test_words_across_lines_are_learned_by_their_parts(monkeypatch):
    with open(TOKENIZER, encoding="utf-8") as file:
        encoder = tokenfiles.Encoder(file.read())
    texts = ["Some words.\nMore Wörter*** and\n12 more.", "Some words"]
    want = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    asked = []
    monkeypatch.setattr(encoder, "_encode", lambda pieces: asked.extend(pieces) or iter(()))
    for _ in range(2):
        ids, sizes = encoder.encode(pa.array(texts))
        assert list(ids) == want[0] + want[1] and list(sizes) == [len(w) for w in want]
    assert not asked


def test_tokenizer_of_another_kind_gets_whole_texts():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        encoder = tokenfiles.Encoder(file.read())
    ids, sizes = encoder.encode(["Some Text", ""])
    assert not encoder.by_piece and list(ids) == encoder.tokenizer.encode("Some Text", add_special_tokens=False).ids
    assert list(sizes) == [len(ids), 0]


def test_files_are_read_by_many_tasks(spark):
    ready(spark)
    table = spark.createDataFrame([(i, prose(i, 400)) for i in range(3000)], "doc_id bigint, text string")
    files = tokenfiles.write_files(table, TOKENIZER, range_bytes=500_000)
    tasks = tokenfiles.read_documents(files).select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks == files.count() > 3


def test_token_files_of_an_empty_table(spark):
    assert tokenfiles.report(spark.createDataFrame([], "doc_id bigint, text string"), TOKENIZER).count() == 0


# --- divergence


def audit_by_hand(rows: list[tuple], min_docs: int, top: int) -> Counter:
    docs = [
        (lang or "", source or "", Counter(re.findall(divergence.TERM, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))))
        for _, text, lang, source in rows
    ]
    out = Counter()
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        frequency = Counter(t for d in mine for t in d[2])
        kept = [t for t, n in frequency.items() if n >= min_docs]
        groups = {s: sum((d[2] for d in mine if d[1] == s), Counter()) for s in {d[1] for d in mine}}

        def shares(counts):
            size = sum(counts[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // size for t in kept}

        whole = shares(sum(groups.values(), Counter()))
        for source, counts in groups.items():
            p, found = shares(counts), {"pair": [], "term": []}
            for item, others in groups.items():
                q = shares(others)
                if item != source:
                    found["pair"].append((item, sum((p[t] - q[t]) ** 2 // q[t] for t in kept)))
            for t in kept:
                if counts[t] and p[t] > whole[t]:
                    found["term"].append((t, (p[t] - whole[t]) ** 2 // whole[t]))
            for part, items in found.items():
                items.sort(key=lambda i: (-i[1], i[0].encode()))
                for rank, (item, value) in enumerate(items[: None if part == "pair" else top], 1):
                    out[lang, source, part, item, value, rank] += 1
    return out


def sources() -> list[tuple]:
    draw = random.Random(8)
    rows = [
        (1, None, None, None), (2, "", "", "s1"), (3, "Abc aBC É é 12 abc", "en", "s1"), (4, "alone", "xx", "s1"), (5, "alone two", "xx", "s2"),
        (6, None, "en", "silent"), (6, "x\u0000y z" * 3, "en\u0000z", "s1"), (9, prose(1, 5000), "en", "s2"), (9, prose(1, 5000), "en", "s2"),
    ]
    for i in range(240):
        lang = draw.choice(["en", "en", "de", None])
        source = "s0" if i % 3 == 0 else draw.choice(["s1", "s2", "s3", None])
        rows.append((i, prose(i % 70, draw.randint(0, 60), "abcdEFé"), lang, source))
    return rows


@pytest.mark.parametrize("max_terms", [1_000_000, 150])
def test_divergence_equals_brute_force(spark, max_terms):
    rows = sources()
    table = spark.createDataFrame(rows, DOC).repartition(4)
    table = table.withColumns({"terms": F.lit("x"), "count": F.lit(1), "term": F.lit("t"), "p": F.lit(0), "item": F.lit(2), "vector": F.lit(3)})
    got = Counter(tuple(r) for r in divergence.audit(table, top=25, max_terms=max_terms).collect())
    assert got == audit_by_hand(rows, 3, 25)


def test_a_chunk_sends_terms_a_few_times_only():
    """Lists of three chunks against counts by hand; a chunk's repeated documents are not sent one by one."""
    draw = random.Random(3)
    learned, counted, entries = Counter(), Counter(), 0
    documents, occurrences = Counter(), Counter()
    for _ in range(3):
        rows = [(draw.choice(["en", "de"]), draw.choice(["a", "b"]), prose(draw.randint(0, 40), 200, "abC")) for _ in range(500)]
        columns = [pa.array(c, pa.string()) for c in zip(*rows)]
        for batch in divergence.chunk_lists(columns[2], columns[0], columns[1], 4, 3):
            for r in batch.to_pylist():
                assert len(set(r["terms"])) == len(r["terms"])
                entries += len(r["terms"])
                for t in r["terms"]:
                    if r["weight"]:
                        counted[r["lang"], r["source"], t] += r["weight"]
                    else:
                        learned[t] += 1
        for lang, source, text in rows:
            words = Counter(lang + divergence.MARK + w for w in text.lower().split())
            documents.update(set(words))
            for w, n in words.items():
                occurrences[lang, source, w] += n
    assert counted == occurrences
    assert all(learned[t] == n if n < 3 else learned[t] >= 3 for t, n in documents.items()) and set(learned) == set(documents)
    assert entries < sum(documents.values()) / 10


def test_divergence_adds_up_chunks_before_terms_are_listed(spark):
    """The same words in every chunk: a list has a term as often as if all documents were one chunk."""
    draw = random.Random(5)
    rows = [(i, prose(i % 50, 80, "abC"), draw.choice(["en", "de", None]), draw.choice(["a", "b\n", None])) for i in range(400)]
    table = ready(spark).createDataFrame(rows, DOC).repartition(8)
    learned, counted, entries = Counter(), Counter(), 0
    for r in divergence.term_lists(divergence.bucket_counts(table), 3, 3).collect():
        assert len(set(r.terms)) == len(r.terms)
        for t in r.terms:
            if r.weight:
                counted[r.lang, r.source, t] += r.weight
                entries += 1
            else:
                learned[t] += 1
    documents, occurrences = Counter(), Counter()
    for _, text, lang, source in rows:
        words = Counter((lang or "") + divergence.MARK + w for w in text.lower().split())
        documents.update(set(words))
        for w, n in words.items():
            occurrences[lang or "", source or "", w] += n
    assert counted == occurrences and learned == {t: min(n, 3) for t, n in documents.items()}
    assert entries == sum(n.bit_count() for n in occurrences.values())


def test_divergence_shares_are_exact_where_longs_end(spark):
    counts = [0, 1, 7, divergence.LONG - 1, divergence.LONG, divergence.LONG + 1, 10**15]
    table = spark.createDataFrame([(c, s) for c in counts for s in (1, 3, 10**9 + 7, 10**16) if (c + 1) // s < 10**9], "c bigint, s bigint")
    for c, s, p in table.select("c", "s", divergence.share(F.col("c"), F.col("s"))).collect():
        assert p == 1 + 10**9 * (c + 1) // s


def test_pairs_of_sources_do_not_depend_on_how_they_are_numbered(monkeypatch):
    draw = random.Random(6)
    rows = [(term, g, draw.randint(1, 10**9), 5 + g) for term in range(200) for g in sorted(draw.sample(range(9), 4))]
    batch = pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows)], names=["index", "gid", "p", "p0"])

    def found():
        return {(r["gid"], r["other"]): r["value"] for b in divergence._common(iter([batch])) for r in b.to_pylist()}

    def gap(p, q):
        return (p - q) ** 2 // q

    by_hand = Counter()
    for i, a, p, p0 in rows:
        for j, b, q, q0 in rows:
            if i == j and a != b:
                by_hand[a, b] += gap(p, q) - gap(p, q0) - gap(p0, q) + gap(p0, q0)
    assert found() == by_hand
    monkeypatch.setattr(divergence, "PAIRS", 16)
    assert found() == by_hand


def test_divergence_without_kept_terms(spark):
    rows = [(1, "a", "en", "s1"), (2, "b", "en", "s2"), (3, "c", "de", "s1")]
    got = {tuple(r) for r in divergence.audit(spark.createDataFrame(rows, DOC)).collect()}
    assert got == {("en", "s1", "pair", "s2", 0, 1), ("en", "s2", "pair", "s1", 0, 1)}
    assert divergence.audit(spark.createDataFrame([], DOC)).count() == 0


# --- archives


def test_archives_are_read_by_many_tasks(spark):
    ready(spark)
    pages = spark.createDataFrame([(i, f"u{i}", prose(i, 900)) for i in range(400)], "page_id bigint, url string, html string")
    archives = warc.write_archives(spark, pages)
    got = warc.read_archives(archives, range_bytes=40_000)
    tasks = got.select(F.spark_partition_id().alias("p")).distinct().count()
    ranges = archives.agg(F.sum(F.ceil(F.col("bytes") / 40_000))).first()[0]
    assert got.count() == 400 and ranges >= 8 and tasks >= ranges // 2
