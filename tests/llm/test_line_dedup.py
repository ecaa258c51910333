import hashlib
import random
from collections import defaultdict

from lakeloom.llm import line_dedup
from tests.llm.conftest import AZ

WHITE = " \t\n\x0b\x0c\r"


def brute(rows, min_chars=40, min_docs=5):
    key = lambda x: x.strip(WHITE).translate(AZ)
    holders = defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= min_chars and i is not None:
                holders[key(x)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(holders.get(key(x), ())) < min_docs or max(holders[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_matches_brute_force(docs):
    rng = random.Random(5)
    pool = [f"this line number {k} is shared by many documents ü {'x' * k}" for k in range(12)] + ["short", "", "  \t"]
    rows = [(i, "\n".join(rng.choice(["", " ", "\t"]) + rng.choice([str.upper, str])(rng.choice(pool)) for _ in range(rng.randrange(1, 9)))) for i in range(60)]
    rows += [(None, pool[0]), (100, None), (101, ""), (102, pool[3]), (102, pool[3]), (103, pool[2] + "\n" + "word " * 40_000)]
    df = docs(rows)
    assert rows_of(line_dedup.line_report(df)) == brute(rows)


def test_exactly_min_docs_and_min_chars(docs):
    line, short = "a" * 40, "b" * 39
    rows = [(i, f"{line}\n{short}") for i in range(5)]
    assert rows_of(line_dedup.line_report(docs(rows))) == brute(rows)
    rows = rows[:4]
    out = rows_of(line_dedup.line_report(docs(rows)))
    assert out == brute(rows) and all(r[2] == 0 for r in out)


def test_other_columns_pass_and_clashes_are_replaced(docs):
    df = docs([(i, "one line that is long enough to be counted here") for i in range(6)]).withColumnRenamed("n", "n_lines")
    out = line_dedup.dedup_lines(df)
    assert sorted(out.columns) == sorted([*df.columns, "n_dropped"])
    got = {r.doc_id: (r.text, r.n_lines, r.n_dropped, r.tokens) for r in out.collect()}
    assert got[5] == ("one line that is long enough to be counted here", 1, 0, "y") and got[0] == ("", 1, 1, "y")


def test_empty_table(docs):
    assert line_dedup.dedup_lines(docs([])).count() == 0


def test_full_filter_only_costs_rows(docs, monkeypatch):
    monkeypatch.setattr(line_dedup, "MAX_FILTER_MB", 1)
    monkeypatch.setattr(line_dedup, "filter_bits", lambda lines: 1 << line_dedup.SHARD_BITS)
    rows = [(i, f"line {i % 7} of a text that is held by several documents\nand line {i} is held by one document only") for i in range(50)]
    assert rows_of(line_dedup.line_report(docs(rows))) == brute(rows)


def test_clashing_columns_and_many_repeated_lines(spark, docs, monkeypatch):
    from lakeloom.llm import _io
    monkeypatch.setattr(_io, "BROADCAST_ROWS", 2)  # most lines are joined by shuffle, the heaviest are sent
    lines = [f"a line that many documents hold, number {k} of them".ljust(45, ".") for k in range(6)]
    rows = [(i, "\n".join([f"own {i}", *lines[i % 6:], lines[0]])) for i in range(40)]
    df = docs(rows).withColumnsRenamed({"n": "drop", "tokens": "drop_id"}).selectExpr("*", "1 as __drop", "2 as __lines", "3 as n_lines")
    out = line_dedup.dedup_lines(df)
    assert out.columns == [*(c for c in df.columns if c != "n_lines"), "n_lines", "n_dropped"]
    monkeypatch.undo()
    want = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs(rows)).collect()}
    assert {r.doc_id: r.text for r in out.collect()} == want
