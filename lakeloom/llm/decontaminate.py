"""Benchmark decontamination over a distributed positional inverted index.

``build_index`` stores postings (term, doc_id, positions) of the wanted terms
of all training texts. A phrase is looked up from its rarest terms: the
positions of each, less the term's offset in the phrase, are intersected list
by list, so a document leaves as soon as one term does not fit. The terms
that are left are then read only in the documents that are left.

Terms are 64-bit hashes of lower-cased words. Postings and matches are moved
by document or by (document, term), never by a term or a phrase alone, so a
term or a passage that is in each document is spread over the tasks that hold
the documents. Test terms and phrases go to the tasks, in blocks if there are
many, whatever their number.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm import _text
from lakeloom.llm._io import bounded, join_in_blocks, staged, text_batches, unused

WINDOW = 13
#: rarest terms of a phrase whose postings are intersected before the rest
RARE_TERMS = 3
#: test terms that are sent to the tasks at once; more are sent in blocks, each with a pass over the texts
TERM_BLOCK = 2_000_000
#: rows of phrase tables that are sent to the tasks at once
PHRASE_BLOCK = 250_000


def terms_of(docs: DataFrame, id_col: str, text: str = "text") -> DataFrame:
    """(id, terms array<long>) of every text; no words: empty."""
    def run(batches):
        for batch in batches:
            for first, data, offsets in _text.slices(batch.column(1)):
                starts, ends, row = _text.words(data, offsets, _text.ALNUM)
                h = _text.signed(_text.word_hashes(data, starts, ends, folded=True))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(offsets) - 1), _text.lists(h, np.diff(row))],
                                                 ["id", "terms"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(run, "id long, terms array<long>")


def phrases(items: DataFrame, window: int = WINDOW, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(phrase long, item_id, terms): every window of an item; a shorter item
    that has words is one window. Equal windows have one phrase number."""
    terms = terms_of(items.where(F.col(item_id).isNotNull()), item_id, text)
    n = F.size("terms")
    starts = F.when(n >= window, F.sequence(F.lit(0), n - window)).when(n > 0, F.array(F.lit(0))).otherwise(
        F.array().cast("array<int>"))
    rows = terms.select(F.col("id").alias("item_id"), F.explode(F.transform(starts, lambda s: F.slice("terms", s + 1, window))).alias("terms"))
    return rows.distinct().select(F.xxhash64("terms").alias("phrase"), "item_id", "terms")


def term_blocks(terms: DataFrame) -> list[np.ndarray]:
    """The terms of a staged table (term, each once) as sorted arrays of about
    TERM_BLOCK terms, read one after the other."""
    blocks = max(1, -(-terms.count() // TERM_BLOCK))
    for b in range(blocks):
        here = terms.where(F.pmod(F.xxhash64("term"), F.lit(blocks)) == b).select("term").toArrow()["term"]
        yield np.sort(np.asarray(here).astype(np.int64))


def build_index(docs: DataFrame, terms: np.ndarray | None = None, doc_id: str = "doc_id", text: str = "text",
                with_lengths: bool = True) -> DataFrame:
    """Postings (term, doc_id, n_words, positions) of the wanted terms (sorted;
    all if None), in position order. ``n_words`` is the length of the document;
    with ``with_lengths`` a row without term (null) stands for each document, so
    lengths are kept of those without any wanted term. Null ids get no
    postings."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    wanted = None if terms is None else docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        for batch in batches:
            for first, data, offsets in _text.slices(batch.column(1)):
                n = len(offsets) - 1
                known = np.asarray(batch.column(0).slice(first, n).is_valid())
                ids = np.asarray(batch.column(0).slice(first, n).fill_null(0))
                starts, ends, row = _text.words(data, offsets, _text.ALNUM)
                h = _text.signed(_text.word_hashes(data, starts, ends, folded=True))
                length = np.diff(row)
                doc = np.repeat(np.arange(n), length)
                place = (np.arange(len(h)) - row[doc]).astype(np.int32)
                if wanted is not None:
                    table = wanted.value
                    at = np.minimum(np.searchsorted(table, h), max(len(table) - 1, 0))
                    keep = (table[at] == h) if len(table) else np.zeros(len(h), bool)
                    h, doc, place = h[keep], doc[keep], place[keep]
                keep = known[doc]
                h, doc, place = h[keep], doc[keep], place[keep]
                order = np.lexsort((place, h, doc))
                h, doc, place = h[order], doc[order], place[order]
                new = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])]) if len(h) else np.zeros(0, np.int64)
                counts = np.diff(np.r_[new, len(h)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[new]), pa.array(ids[doc[new]]), pa.array(length[doc[new]].astype(np.int64)), _text.lists(place, counts)],
                    ["term", "doc_id", "n_words", "positions"])
                if not with_lengths:
                    continue
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(n, pa.int64()), batch.column(0).slice(first, n), pa.array(length.astype(np.int64)),
                     _text.lists(np.zeros(0, np.int32), np.zeros(n, np.int64))], ["term", "doc_id", "n_words", "positions"])

    return docs.mapInArrow(run, "term long, doc_id long, n_words long, positions array<int>")


def frequencies(docs: DataFrame, terms: np.ndarray, text: str = "text") -> DataFrame:
    """(term, n) occurrences in the texts, at most one row a wanted term
    (``terms`` sorted)."""
    wanted = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        table = wanted.value
        total = np.zeros(len(table) + 1, np.int64)
        for batch in batches:
            for _, data, offsets in _text.slices(batch.column(0)):
                starts, ends, _ = _text.words(data, offsets, _text.ALNUM)
                h = _text.signed(_text.word_hashes(data, starts, ends, folded=True))
                if len(table) and len(h):
                    at = np.minimum(np.searchsorted(table, h), len(table) - 1)
                    total += np.bincount(np.where(table[at] == h, at, len(table)), minlength=len(table) + 1)
        seen = np.flatnonzero(total[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(table[seen]), pa.array(total[seen])], ["term", "n"])

    return docs.select(text).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


def _offsets(phrase: DataFrame, df: DataFrame) -> DataFrame:
    """(phrase, size, rank, term, offset): the first offset of each different
    term of a phrase, from the rarest. A term that no text has ranks first."""
    each = phrase.select("phrase", F.size("terms").alias("size"), F.posexplode("terms").alias("offset", "term"))
    each = each.groupBy("phrase", "size", "term").agg(F.min("offset").alias("offset"))
    each = each.join(df, "term", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    listed = each.groupBy("phrase", "size").agg(F.array_sort(F.collect_list(F.struct("n", "term", "offset"))).alias("t"))
    return listed.select("phrase", "size", F.posexplode("t").alias("rank", "t")).select("phrase", "size", "rank", "t.term", "t.offset")


def phrase_candidates(index: DataFrame, offsets: DataFrame, terms: int = RARE_TERMS) -> DataFrame:
    """(doc_id, phrase, starts): where the ``terms`` rarest terms of a phrase
    all stand at their offsets, by intersecting one list after the other."""
    index = index.where(F.col("term").isNotNull())
    found = None
    for rank in range(terms):
        step = offsets.where(F.col("rank") == rank).select("phrase", "term", F.col("offset"))
        if found is None:
            found = join_in_blocks(index, step, "term", PHRASE_BLOCK).select(
                "doc_id", "phrase", F.filter(F.transform("positions", lambda p: p - F.col("offset")), lambda s: s >= 0).alias("starts"))
        else:
            # Phrases with fewer different terms keep their lists.
            ready = step.withColumnRenamed("term", "next")
            short = offsets.groupBy("phrase").agg(F.max("rank").alias("most")).where(F.col("most") < rank).select("phrase")
            ready = ready.unionByName(short.select("phrase", F.lit(None).cast("long").alias("next"), F.lit(None).cast("int").alias("offset")))
            left = join_in_blocks(found, ready, "phrase", PHRASE_BLOCK)
            lists = index.select("doc_id", F.col("term").alias("next"), "positions")
            both = left.join(lists, ["doc_id", "next"], "left")
            found = both.select("doc_id", "phrase", F.when(F.col("next").isNull(), F.col("starts")).otherwise(
                F.array_intersect("starts", F.transform("positions", lambda p: p - F.col("offset")))).alias("starts"))
        found = found.where(F.size("starts") > 0)
    return found


def phrase_matches(docs: DataFrame, phrase: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Exact matches (doc_id, phrase, size, starts array<int>) of all phrases
    (phrase, terms) in all texts, and the lengths (doc_id, n_words).

    Postings of the rarest terms are stored first; documents in which all of
    those line up are read again for the postings of the other terms."""
    text_batches(docs.sparkSession)
    phrase = staged(phrase.select("phrase", "terms").distinct(), "phrases")
    counted = [frequencies(docs, block, text) for block in term_blocks(_terms(phrase))]
    df = staged(reduce(DataFrame.unionByName, counted), "frequencies")
    offsets = staged(_offsets(phrase, df), "offsets")
    rare = staged(offsets.where(F.col("rank") < RARE_TERMS).select("term").distinct(), "rare-terms")
    index = staged(_index_of(docs, rare, doc_id, text), "postings")
    found = staged(phrase_candidates(index, offsets), "candidates")
    # Repeated ids share postings; they are told apart only here, as one text.
    wanted = unused("wanted", docs)
    ids = staged(found.select(F.col("doc_id").alias(wanted)).distinct(), "candidate-ids")
    again = docs.join(bounded(ids), F.col(doc_id).cast("long") == F.col(wanted), "left_semi")
    whole = terms_of(again, doc_id, text).withColumnRenamed("id", "doc_id")
    checked = (join_in_blocks(found, phrase, "phrase", PHRASE_BLOCK).join(whole.withColumnRenamed("terms", "doc_terms"), "doc_id")
               .select("doc_id", "phrase", F.size("terms").alias("size"), F.filter(
                   "starts", lambda s: F.slice("doc_terms", s + 1, F.size("terms")) == F.col("terms")).alias("starts")))
    lengths = index.where(F.col("term").isNull()).select("doc_id", "n_words")
    return checked.where(F.size("starts") > 0), lengths


def _terms(phrase: DataFrame) -> DataFrame:
    return staged(phrase.select(F.explode("terms").alias("term")).distinct(), "terms")


def _index_of(docs: DataFrame, terms: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Postings of all terms of a staged table, and the row of each document."""
    parts = [build_index(docs, block, doc_id, text, with_lengths=k == 0) for k, block in enumerate(term_blocks(terms))]
    return reduce(DataFrame.unionByName, parts)


def proximity_matches(docs: DataFrame, queries: DataFrame, slop: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, query, start, end): for each document that has all terms of a
    query (query, terms) the narrowest span (end exclusive, first of equal
    ones) that holds each term, if it is at most ``slop`` words wider than the
    number of different terms."""
    text_batches(docs.sparkSession)
    queries = staged(queries.select(F.col("query"), F.array_distinct("terms").alias("terms")), "queries")
    index = staged(_index_of(docs, _terms(queries), doc_id, text), "postings").where("term is not null")
    each = queries.select("query", F.size("terms").alias("n"), F.explode("terms").alias("term"))
    lists = join_in_blocks(index, each, "term", PHRASE_BLOCK).select("query", "doc_id", "n", "term", F.explode("positions").alias("at"))
    # Per (query, document), the last place of each term up to a place.
    grouped = lists.groupBy("query", "doc_id", "n").agg(F.array_sort(F.collect_list(F.struct("at", "term"))).alias("p"),
                                                        F.count_distinct("term").alias("have")).where("have = n")

    def narrowest(batches):
        for batch in batches:
            for q, d, n, p in zip(*(batch.column(i).to_pylist() for i in range(4))):
                last, best = {}, None
                for x in p:
                    last[x["term"]] = x["at"]
                    if len(last) == n and (best is None or x["at"] + 1 - min(last.values()) < best[1] - best[0]):
                        best = (min(last.values()), x["at"] + 1)
                if best[1] - best[0] <= n + slop:
                    yield pa.RecordBatch.from_pylist([{"query": q, "doc_id": d, "start": best[0], "end": best[1]}],
                                                     pa.schema([("doc_id", pa.int64()), ("query", pa.int64()), ("start", pa.int32()), ("end", pa.int32())]))

    return grouped.select(F.col("query").cast("long"), "doc_id", "n", "p").mapInArrow(narrowest, "query long, doc_id long, start int, end int")


def _covered(spans):
    """Words covered by sorted (start, size) spans."""
    return F.aggregate(spans, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), lambda a, s: F.struct(
        F.greatest(a["end"], s["start"] + s["size"]).alias("end"),
        (a["n"] + F.greatest(F.lit(0), s["start"] + s["size"] - F.greatest(a["end"], s["start"]))).alias("n")), lambda a: a["n"])


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, least_percent: int = 5,
                  doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row a document: doc_id, n_words, n_hit, n_items, items (sorted as
    strings), contaminated.

    A word is hit if it lies in any occurrence of a window; a document is
    contaminated if some word is hit and hits are ``least_percent`` percent of
    its words or more. Null and empty texts have no words. Items that are null,
    empty or without words have no window. Documents with a null id get no
    hits. Rows that repeat an id each come back; if their texts differ, an
    occurrence in any of them counts for the id. Without benchmark items all
    documents are clean; an empty table gives an empty table; other columns
    are ignored.
    """
    phrase = staged(phrases(items, window, item_id, item_text), "windows")
    matches, lengths = phrase_matches(docs, phrase, doc_id, text)
    spans = matches.groupBy("doc_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.transform(
        "starts", lambda s: F.struct(s.alias("start"), F.col("size").alias("size"))))))).alias("spans"),
        F.collect_set("phrase").alias("phrases"))
    by_phrase = phrase.select("phrase", "item_id")
    named = (join_in_blocks(spans.select("doc_id", F.explode("phrases").alias("phrase")), by_phrase, "phrase", PHRASE_BLOCK)
             .groupBy("doc_id").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items")))
    hits = staged(spans.select("doc_id", _covered(F.col("spans")).cast("long").alias("n_hit")).join(named, "doc_id"), "hits")
    out = lengths.join(bounded(hits), "doc_id", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    found = F.coalesce("items", F.array().cast("array<string>"))
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(found).cast("long").alias("n_items"), found.alias("items"),
                      ((n_hit > 0) & (n_hit * 100 >= F.col("n_words") * least_percent)).alias("contaminated"))


def remove_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without the contaminated ones, all columns as they were.

    Rows with a null id and rows whose text is null, empty or without words
    stay. Rows that repeat an id stay or go together. An empty table gives an
    empty table."""
    doc_id = options.get("doc_id", "doc_id")
    bad = unused("bad", docs)
    gone = staged(contamination(docs, items, **options).where("contaminated").select(F.col("doc_id").alias(bad)).distinct(), "contaminated")
    return docs.join(bounded(gone), F.col(doc_id).cast("long") == F.col(bad), "left_anti")
