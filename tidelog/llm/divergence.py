"""How far the vocabulary of each source lies from the other sources of its language.

**Rows of terms.** Documents are read once, some ``CHUNK`` bytes of text at a time, and the terms of a chunk are counted for each
(language, source): occurrences, and documents. These counts are dealt by the term's hash to ``BUCKETS``, a small Arrow table for each chunk and bucket;
the tables of a bucket meet after one shuffle, where up to ``CHUNK`` bytes of them at a time are added up and written as lists of different
terms. For the vocabulary such a sum sends ``min_docs`` lists a language: list k has the terms that more than k of its documents have. So a term is in as many
lists, over all sums, as documents have it, or in ``min_docs`` at least. For the counts it sends a list per group and bit: the terms
whose number of occurrences has that bit set, with the bit's weight. Nothing is lost by either, and a term that many chunks repeat is written a few times.

**Vectors.** ``CountVectorizer`` with ``minDF`` and the largest integer as ``vocabSize`` learns from the lists and turns them into exact
sparse vectors. A term carries its language, so one model holds every language's vocabulary: a term of a language is in it if enough of that
language's documents have it. A model's vocabulary lies in the driver and goes to every task; so that its size is bounded, terms are dealt
by hash to as many models as their number asks for (about ``max_terms`` each), which is estimated from the kept terms of one
bucket. Results do not depend on the number of models.

**Group sums.** Vector entries times their weight are summed per (language, source) and index, on sparse entries and in whole numbers.

**Sparse pairs.** A pair's value is a sum over all kept terms, of which a source has few. With f0 the value where both counts are 0, the sum
is V f0, plus f(p, q0) - f0 over the terms of the one, plus f(p0, q) - f0 over those of the other, plus what is still missing
over terms of both. The first two come from how often each share occurs. For the last the rows of a term meet in one task, at most one
a source; pairs are made in blocks and summed there, so what is shuffled on is one row a pair of sources and task.

Defined cases: null text, language and source are empty strings. Documents are rows, repeated ones too. A language without
kept terms has pairs of value 0 and no ``term`` rows; a source alone in its language has no pair. Ties are ranked by
the bytes of the item. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelog.llm.common import Alphabet, buffers, hash_words, ready, text_of, word_bounds, written
from tidelog.sources.scratch import scratch_dir

# Fixed values of the contract. In UTF-8 a term is a run of ASCII letters and bytes from 0x80 on.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCS, WHOLE, TOP = 3, 10**9, 200
# Below this, WHOLE (count + 1) is a long.
LONG = (2**63 - 1) // WHOLE

MAX_VOCABULARY = 2**31 - 1
# Between a language and a term; terms have no such character.
MARK = "\u0000"
LETTERS = Alphabet(bytes(b for b in range(128) if not chr(b).isalpha()), lower=True)
FOLD = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)
# Terms of a model, whose vocabulary lies in the driver, and bytes of text, or of counts, whose terms are counted together.
MAX_TERMS, CHUNK = 100_000, 16 << 20
BUCKET_BITS = 8
BUCKETS = 1 << BUCKET_BITS


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each pair of a start and a size, one after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


def _terms_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """All terms of the texts in lower case, as numbers of the list of different terms; and the text of each."""
    data, cuts = buffers(texts)
    starts, ends = word_bounds(data, cuts, 0, len(data), LETTERS.is_word)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)])
    letters = FOLD[data[LETTERS.is_word[data]]]
    terms = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(letters))
    coded = terms.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.searchsorted(cuts, starts, "right") - 1, coded.dictionary


def _counted(high: np.ndarray, low: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different pairs of numbers, and how often each occurs. The second numbers are below ``width``."""
    pairs, counts = np.unique(high * width + low, return_counts=True)
    return pairs // width, pairs % width, counts


def _summed(keys: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """The different keys, and the sums of each of the values by key."""
    if not len(keys):
        return [keys, *values]
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    begins = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
    return [keys[begins], *(np.add.reduceat(v[order], begins) for v in values)]


def _coded(codes: np.ndarray, values: pa.Array) -> pa.DictionaryArray:
    return pa.DictionaryArray.from_arrays(pa.array(codes.astype(np.int32)), values)


def _codes(column: pa.DictionaryArray) -> np.ndarray:
    return column.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def chunk_counts(texts: pa.Array, langs: pa.Array, sources: pa.Array) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Buckets, and the ``lang``, ``source``, ``term``, ``count`` and ``docs`` of their terms in a chunk."""
    codes, doc, terms = _terms_of(texts)
    if not len(codes):
        return
    bucket = (hash_words(*buffers(terms), LETTERS)[0] >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    # Terms are numbered by bucket.
    order = np.argsort(bucket, kind="stable")
    number = np.empty(len(terms), dtype=np.int64)
    number[order] = np.arange(len(terms))
    langs, sources = langs.dictionary_encode(), sources.dictionary_encode()
    several = len(sources.dictionary)
    groups = len(langs.dictionary) * several
    of, term, times = _counted(doc, number[codes], len(terms))
    keys, count, docs = _summed(term * groups + (_codes(langs) * several + _codes(sources))[of], times, np.ones_like(times))
    term, group = keys // groups, keys % groups
    begins = np.searchsorted(bucket[order], np.arange(BUCKETS + 1))
    cuts = np.searchsorted(term, begins)
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        rows, own = slice(cuts[b], cuts[b + 1]), slice(begins[b], begins[b + 1])
        columns = [_coded(term[rows] - begins[b], terms.take(pa.array(order[own])))]
        for code, names in ((group[rows] // several, langs.dictionary), (group[rows] % several, sources.dictionary)):
            used, code = np.unique(code, return_inverse=True)
            columns.append(_coded(code, names.take(pa.array(used))))
        yield b, pa.record_batch([*columns, pa.array(count[rows], pa.int32()), pa.array(docs[rows], pa.int32())], names=["term", "lang", "source", "count", "docs"])


LISTS = "part int, lang string, source string, weight bigint, terms array<string>"


def lists_of(counted: list[pa.Table], parts: int, min_docs: int) -> Iterator[pa.RecordBatch]:
    """The lists of the added counts: with weight 0 for the vocabulary, without a source, and with other weights for the counts."""
    if not counted:
        return
    table = pa.concat_tables(counted).unify_dictionaries().combine_chunks()
    column = {name: pa.concat_arrays(table[name].chunks) for name in table.column_names}
    langs, sources, terms = (column[name].dictionary for name in ("lang", "source", "term"))
    lang, source, term = (_codes(column[name]) for name in ("lang", "source", "term"))
    several, width = len(sources), len(terms)
    named = pa.array([v + MARK for v in langs.to_pylist()], pa.string())
    dealt = (hash_words(*buffers(terms), LETTERS)[0] % np.uint64(parts)).astype(np.int64)

    def lists(group: np.ndarray, term: np.ndarray, layer: np.ndarray, weighted: bool) -> pa.RecordBatch:
        key = (dealt[term] * len(langs) * several + group) * 64 + layer
        order = np.argsort(key, kind="stable")
        begins = np.flatnonzero(np.diff(key[order], prepend=-1))
        of = group[order][begins]
        whose = group[order] // several
        marked = pc.binary_join_element_wise(named.take(pa.array(whose)), terms.take(pa.array(term[order])), "")
        weight = np.left_shift(1, layer[order][begins]) if weighted else np.zeros(len(begins), np.int64)
        columns = [
            pa.array(dealt[term[order][begins]].astype(np.int32)), langs.take(pa.array(of // several)),
            sources.take(pa.array(of % several, mask=np.full(len(of), not weighted))),
            pa.array(weight), pa.ListArray.from_arrays(pa.array(np.append(begins, len(key)), pa.int32()), marked),
        ]
        return pa.record_batch(columns, names=[c.split()[0] for c in LISTS.split(", ")])

    def layers(group: np.ndarray, term: np.ndarray, levels: Iterator[np.ndarray], weighted: bool) -> pa.RecordBatch:
        chosen = [np.flatnonzero(level) for level in levels]
        rows = np.concatenate(chosen)
        return lists(group[rows], term[rows], np.repeat(np.arange(len(chosen)), [len(c) for c in chosen]), weighted)

    keys, having = _summed(lang * width + term, column["docs"].to_numpy().astype(np.int64))
    yield layers(keys // width * several, keys % width, (having > k for k in range(max(min_docs, 1))), False)
    keys, times = _summed((lang * several + source) * width + term, column["count"].to_numpy().astype(np.int64))
    yield layers(keys // width, keys % width, (times >> b & 1 for b in range(int(times.max()).bit_length())), True)


def chunk_lists(texts: pa.Array, langs: pa.Array, sources: pa.Array, parts: int, min_docs: int) -> Iterator[pa.RecordBatch]:
    """The lists of a chunk alone."""
    yield from lists_of([pa.Table.from_batches([counted]) for _, counted in chunk_counts(texts, langs, sources)], parts, min_docs)


COUNTED = "bucket int, counted binary"


def bucket_counts(docs: DataFrame) -> DataFrame:
    """``bucket`` and ``counted``: the counts of a chunk's terms of a bucket, as an Arrow stream. The rows of a bucket lie together."""

    def packed(counted: pa.RecordBatch) -> bytes:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, counted.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as stream:
            stream.write_batch(counted)
        return sink.getvalue().to_pybytes()

    def chunk(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, source, text = (pa.concat_arrays([b.column(i) for b in held]) for i in range(3))
        found = [(b, packed(counted)) for b, counted in chunk_counts(text, lang, source)]
        if found:
            buckets, tables = zip(*found)
            yield pa.record_batch([pa.array(buckets, pa.int32()), pa.array(tables, pa.binary())], names=["bucket", "counted"])

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in chain(batches, [None]):
            if held and (batch is None or size + batch.nbytes > CHUNK):
                yield from chunk(held)
                held, size = [], 0
            if batch is not None:
                held.append(batch)
                size += batch.nbytes

    rows = docs.select(*[text_of(c).alias(c) for c in ("lang", "source", "text")])
    return written(rows.mapInArrow(take, COUNTED).repartition("bucket").sortWithinPartitions("bucket"), "bucket-counts")


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    for batch in batches:
        for packed in batch.column("counted"):
            yield pa.ipc.open_stream(packed.as_buffer()).read_all()


def term_lists(counted: DataFrame, parts: int, min_docs: int) -> DataFrame:
    """``part``, ``lang``, ``source``, ``weight`` and ``terms``: the lists of the counts, added up while they fit."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        for table in _tables(batches):
            if held and total + table.nbytes > CHUNK:
                yield from lists_of(held, parts, min_docs)
                held, total = [], 0
            held.append(table)
            total += table.nbytes
        yield from lists_of(held, parts, min_docs)

    return counted.mapInArrow(take, LISTS)


def models_needed(counted: DataFrame, min_docs: int, max_terms: int) -> int:
    """How many models hold all kept terms, from those of one bucket."""

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _tables(batches):
            names = [table[c].cast(pa.string()) for c in ("lang", "term")]
            yield from pa.table([*names, table["docs"].cast(pa.int64())], names=["lang", "term", "docs"]).to_batches()

    found = counted.where("bucket = 0").mapInArrow(sample, "lang string, term string, docs bigint")
    kept = found.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs).count()
    return max(1, -(-(kept << BUCKET_BITS) // max_terms))


def term_counts(docs: DataFrame, min_docs: int = MIN_DOCS, max_terms: int = MAX_TERMS) -> tuple[DataFrame, DataFrame]:
    """Occurrences above 0, per group, of the terms a language keeps (``lang``, ``source``, ``index``, ``count``), and the
    terms (``index``, ``term``). An index belongs to one language."""
    spark, counted = docs.sparkSession, bucket_counts(docs)
    parts = models_needed(counted, min_docs, max_terms)
    counts, names, folder = [], [], scratch_dir(spark, "term-lists")
    lists = term_lists(counted, parts, min_docs)
    lists.withColumn("learned", F.col("weight") == 0).write.partitionBy("part", "learned").parquet(folder)
    lists = spark.read.schema(f"{LISTS}, learned boolean").parquet(folder)
    for part in range(parts):
        rows = lists.where(F.col("part") == part)
        if rows.isEmpty():
            continue
        model = CountVectorizer(
            inputCol="terms", outputCol="vector", minDF=float(min_docs), vocabSize=MAX_VOCABULARY
        ).fit(rows.where("learned"))
        first = part * (MAX_VOCABULARY + 1)
        # A list has no term twice, so all its values are 1.
        entries = model.transform(rows.where("NOT learned")).select(
            "lang", "source", "weight", F.explode(F.unwrap_udt("vector")["indices"]).alias("at")
        )
        sums = entries.groupBy("lang", "source", (F.col("at") + F.lit(first)).alias("index")).agg(F.sum("weight").alias("count"))
        counts.append(written(sums, "term-counts"))
        # The saved model holds the vocabulary in one row, so it need not pass through Python.
        saved = scratch_dir(spark, "vocabulary")
        model.save(saved)
        marked = spark.read.parquet(f"{saved}/data").select(F.posexplode("vocabulary").alias("at", "marked"))
        names.append(marked.select((F.col("at") + F.lit(first)).alias("index"), F.substring_index("marked", MARK, -1).alias("term")))
    if not counts:
        empty = "lang string, source string, index bigint, count bigint"
        return spark.createDataFrame([], empty), spark.createDataFrame([], "index bigint, term string")
    for more in range(1, len(counts)):
        counts[0], names[0] = counts[0].unionByName(counts[more]), names[0].unionByName(names[more])
    return counts[0], names[0]


def share(count: Column, size: Column) -> Column:
    """1 + floor(WHOLE (count + 1) / size), exact. In whole numbers of 64 bits where the product fits."""
    scaled = F.lit(WHOLE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    wide = F.call_function("div", scaled, size.cast("decimal(20,0)"))
    return F.lit(1) + F.when(count < LONG, F.call_function("div", F.lit(WHOLE).cast("long") * (count + 1), size)).otherwise(wide)


def gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def audit(docs: DataFrame, *, min_docs: int = MIN_DOCS, top: int = TOP, max_terms: int = MAX_TERMS) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``: other sources and own terms by divergence."""
    ready(docs.sparkSession)
    counts, names = term_counts(docs, min_docs, max_terms)
    keys = ["lang", "source"]
    kept = written(counts.groupBy("lang", "index").agg(F.sum("count").alias("all")), "kept")
    sizes = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("all").alias("n_lang"))
    occurring = docs.select(*[text_of(k).alias(k) for k in keys]).distinct()
    groups = written(
        occurring.join(counts.groupBy(*keys).agg(F.sum("count").alias("n")), keys, "left")
        .join(sizes, "lang", "left")
        .na.fill(0, ["n", "v", "n_lang"])
        .withColumn("size", F.col("n") + F.col("v"))
        .withColumn("p0", F.when(F.col("size") > 0, share(F.lit(0), F.col("size"))))
        .withColumn("gid", F.monotonically_increasing_id()),
        "groups",
    )
    shares = counts.join(groups.select(*keys, "gid", "size", "p0"), keys)
    rows = written(shares.select("index", "gid", share(F.col("count"), F.col("size")).alias("p"), "p0"), "shares")
    return _pairs(rows, groups).unionByName(_terms(rows, groups, kept, sizes, names, top))


def _ranked(rows: DataFrame, part: str, most: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc())
    ranked = rows.withColumn("rank", F.row_number().over(order))
    ranked = ranked if most is None else ranked.where(F.col("rank") <= most)
    return ranked.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def _terms(
    rows: DataFrame, groups: DataFrame, kept: DataFrame, sizes: DataFrame, names: DataFrame, top: int
) -> DataFrame:
    """Terms a group uses more than its language. The rank filter cuts groups in tasks before they are shuffled, and names are
    joined to what it leaves, ties with the last rank included."""
    langs = kept.join(sizes, "lang").select("index", share(F.col("all"), F.col("n_lang") + F.col("v")).alias("q"))
    above = rows.join(langs, "index").where("p > q").select("gid", "index", gap(F.col("p"), F.col("q")).alias("value"))
    by_value = Window.partitionBy("gid").orderBy(F.col("value").desc())
    first = above.withColumn("place", F.rank().over(by_value)).where(F.col("place") <= top)
    named = first.join(names, "index").join(groups.select("gid", "lang", "source"), "gid")
    return _ranked(named.select("lang", "source", F.col("term").alias("item"), "value"), "term", top)


def _pairs(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Every other source of a language, from sums over the terms that occur in one of the two."""
    mine = groups.select("lang", "gid", "v", "p0")
    other = groups.select("lang", F.col("gid").alias("other"), F.col("p0").alias("q0"))
    # How many terms of a group have the same share.
    shares = rows.groupBy("gid", "p").agg(F.count("*").alias("terms")).join(mine, "gid")
    theirs = shares.select("lang", F.col("gid").alias("other"), F.col("p0").alias("q0"), F.col("p").alias("q"), "terms")
    p, p0, q, q0 = (F.col(c) for c in ("p", "p0", "q", "q0"))
    neither = F.when(F.col("v") > 0, F.col("v") * gap(p0, q0)).otherwise(0)
    first = F.col("terms") * (gap(p, q0) - gap(p0, q0))
    second = F.col("terms") * (gap(p0, q) - gap(p0, q0))
    parts = [(mine, other, neither), (shares, other, first), (mine, theirs, second)]
    summed = [
        a.join(b, "lang").where("gid <> other").groupBy("gid", "other").agg(F.sum(value).alias("value"))
        for a, b, value in parts
    ]
    # All rows of a term in one task, next to each other.
    whole = rows.repartition("index").sortWithinPartitions("index").mapInArrow(_common, "gid bigint, other bigint, value bigint")
    for more in summed:
        whole = whole.unionByName(more)
    values = whole.groupBy("gid", "other").agg(F.sum("value").alias("value"))
    named = values.join(groups.select("gid", "lang", "source"), "gid").join(
        groups.select(F.col("gid").alias("other"), F.col("source").alias("item")), "other"
    )
    return _ranked(named, "pair")


def _gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


PAIRS, SUMS = 1 << 20, 1 << 20


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is missing over terms that both sources have, summed by pair. Rows (term, group, p, p0) come by term."""
    sums: dict[tuple[int, int], int] = {}

    def out() -> pa.RecordBatch:
        columns = [[a for a, _ in sums], [b for _, b in sums], list(sums.values())]
        return pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["gid", "other", "value"])

    def add(table: np.ndarray) -> None:
        term, group, p, p0 = table
        begins = np.searchsorted(term, term, "left")
        partners = np.searchsorted(term, term, "right") - begins
        groups, code = np.unique(group, return_inverse=True)
        cuts = np.searchsorted(np.cumsum(partners), np.arange(0, int(partners.sum()) + PAIRS, PAIRS))
        for begin, end in zip(cuts, np.append(cuts[1:], len(term))):
            a = np.repeat(np.arange(begin, end), partners[begin:end])
            b = _ranges(begins[begin:end], partners[begin:end])
            a, b = a[a != b], b[a != b]
            value = _gap(p[a], p[b]) - _gap(p[a], p0[b]) - _gap(p0[a], p[b]) + _gap(p0[a], p0[b])
            place = code[a] * len(groups) + code[b]
            if len(groups) ** 2 > PAIRS:
                pairs, place = np.unique(place, return_inverse=True)
            else:
                pairs = np.arange(len(groups) ** 2)
            totals = np.zeros(len(pairs), dtype=np.int64)
            np.add.at(totals, place, value)
            # Groups of two languages have no term in common.
            found = np.flatnonzero(np.bincount(place, minlength=len(pairs)))
            pairs, totals = pairs[found], totals[found]
            for pair, total in zip(pairs.tolist(), totals.tolist()):
                key = int(groups[pair // len(groups)]), int(groups[pair % len(groups)])
                sums[key] = sums.get(key, 0) + total

    rest = np.zeros((4, 0), dtype=np.int64)
    for batch in batches:
        rest = np.concatenate([rest, np.stack([c.to_numpy() for c in batch.columns])], axis=1)
        last = np.searchsorted(rest[0], rest[0][-1]) if rest.shape[1] else 0
        if last >= 1 << 15:  # the last term may go on in the next batch
            add(rest[:, :last])
            rest = rest[:, last:]
        if len(sums) >= SUMS:
            yield out()
            sums.clear()
    add(rest)
    yield out()
