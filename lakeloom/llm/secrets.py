"""Secret scan: fixed patterns plus a randomness test battery.

Patterns give the base spans. Besides, every run of 20 or more key characters
is tested. Its encoding (alphabet) is inferred; under "drawn evenly from the
alphabet" three tests are made: chi-squared uniformity, number of runs above
and below the middle, and serial correlation. Evenness that holds is no proof
in a short run, so a second p-value says how likely a run of *text* of this
length is as even as this one; it is controlled by the Benjamini-Hochberg
procedure over all different runs of the corpus, per length band. A run is
reported if no test speaks against chance and text is ruled out.

All of it is DataFrame functions. p-values are grouped into narrow bins (taken
at their upper end), so the procedure needs one small count table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm._io import staged

ASSIGN = "(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
RUN = "(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "random")

_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: encoding: pattern of its body, alphabet, and the sum of squared symbol
#: frequencies of text written in it (letters of European languages: 0.065;
#: decimal digits: 0.1)
ENCODINGS = {
    "digits": ("^[0-9]+$", _DIGITS, 0.1),
    "hex": ("^[0-9a-f]+$", _DIGITS + "abcdef", 0.1),
    "hex upper": ("^[0-9A-F]+$", _DIGITS + "ABCDEF", 0.1),
    "lower": ("^[a-z]+$", _LOWER, 0.065),
    "upper": ("^[A-Z]+$", _UPPER, 0.065),
    "base32": ("^[A-Z2-7]+$", _UPPER + "234567", 0.065),
    "base36": ("^[a-z0-9]+$", _LOWER + _DIGITS, 0.065),
    "base62": ("^[A-Za-z0-9]+$", _UPPER + _LOWER + _DIGITS, 0.065),
    "base64": ("^[A-Za-z0-9+/]+$", _UPPER + _LOWER + _DIGITS + "+/", 0.065),
    "base64url": ("^[A-Za-z0-9_-]+$", _UPPER + _LOWER + _DIGITS + "-_", 0.065),
    "mixed": ("", _UPPER + _LOWER + _DIGITS + "+/-_=", 0.065),
}
#: lower ends of the length bands
BANDS = (20, 24, 32, 48, 64, 128)
BINS_PER_DECADE = 50
LEAST_P = 1e-12


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


#: matches of a block whose starts are summed up together
BLOCK = 64


def _spans(text: Column, pattern: str, present: Column) -> Column:
    """(s, e, v) of all matches, in code points, end exclusive; none where
    ``present`` (a cheap necessary condition) is false.

    Starts are running sums over the gaps and lengths: within blocks of
    matches, and over the totals of the blocks, so a text with very many
    matches takes about ``BLOCK`` steps a match and not as many as it has."""
    found = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("between"))
    empty = F.array().cast("array<struct<s:int,e:int,v:string>>")

    def blocks(f):
        sized = F.transform(f["m"], lambda m, i: F.struct(F.length(f["between"][i]).alias("gap"), F.length(m).alias("n"), m.alias("v")))
        return _let(sized, lambda x: F.transform(
            F.sequence(F.lit(0), F.floor((F.size(x) - 1) / BLOCK).cast("int")), lambda b: F.slice(x, b * BLOCK + 1, BLOCK)))

    def starts(parts):
        none = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        total = lambda part: F.aggregate(part, F.lit(0), lambda a, x: a + x["gap"] + x["n"])
        return F.aggregate(parts, none, lambda a, part: F.struct(
            (a["at"] + total(part)).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")), lambda a: a["out"])

    def place(part, at):
        def step(a, x):
            s = a["at"] + x["gap"]
            return F.struct((s + x["n"]).alias("at"), F.concat(a["out"], F.array(F.struct(s.alias("s"), (s + x["n"]).alias("e"), x["v"].alias("v")))).alias("out"))

        return F.aggregate(part, F.struct(at.alias("at"), empty.alias("out")), step, lambda a: a["out"])

    placed = lambda parts: F.flatten(F.zip_with(parts, starts(parts), place))
    return F.when(present, _let(found, lambda f: F.when(F.size(f["m"]) > 0, _let(blocks(f), placed)).otherwise(empty))).otherwise(empty)


def _touched(spans: Column, x: Column) -> Column:
    """Whether one of ``spans`` (by start, none overlaps another) overlaps
    ``x``: the last one that starts before its end, by binary search."""
    def step(state, _):
        middle = F.floor((state["lo"] + state["hi"]) / 2).cast("int")
        return F.when(state["lo"] >= state["hi"], state).when(
            F.get(spans, middle)["s"] < x["e"], F.struct((middle + 1).alias("lo"), state["hi"].alias("hi"))).otherwise(
            F.struct(state["lo"].alias("lo"), middle.alias("hi")))

    steps = F.sequence(F.lit(0), F.length(F.bin(F.size(spans).cast("long"))))
    before = F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.size(spans).alias("hi")), step, lambda state: state["lo"])
    return F.coalesce(F.get(spans, before - 1)["e"] > x["s"], F.lit(False))


def _phi(z: Column) -> Column:
    """Normal distribution function, to about 1e-4."""
    z = F.greatest(F.lit(-8.0), F.least(F.lit(8.0), z))
    return 1.0 / (1.0 + F.exp(-(1.5976 * z + 0.070566 * z * z * z)))


def _encoding(body: Column) -> Column:
    out = None
    for name, (pattern, alphabet, even) in ENCODINGS.items():
        value = F.struct(F.lit(name).alias("name"), F.lit(alphabet).alias("alphabet"), F.lit(float(even)).alias("even"))
        if not pattern:
            return out.otherwise(value)
        out = F.when(body.rlike(pattern), value) if out is None else out.when(body.rlike(pattern), value)


def battery(run: Column) -> Column:
    """struct(encoding, p_random, p_text) of a run of key characters.

    ``p_random``: smallest of the three tests' p-values times three (Bonferroni).
    ``p_text``: normal approximation of the chance that text of this length
    has a chi-squared statistic as small as this."""
    def tests(x):
        body, enc = x["body"], x["enc"]
        n, k = F.length(body).cast("double"), F.length(enc["alphabet"]).cast("double")
        squares = F.aggregate(
            F.split(enc["alphabet"], ""), F.lit(0.0), lambda a, c: a + F.pow((n - F.length(F.replace(body, c, F.lit("")))).cast("double"), F.lit(2.0)))
        places = F.transform(F.split(body, ""), lambda c: F.instr(enc["alphabet"], c).cast("double") - 1.0)
        return _let(F.struct(enc["name"].alias("name"), enc["even"].alias("even"), n.alias("n"), k.alias("k"),
                             (squares * k / n - n).alias("chi"), places.alias("x"), F.slice(places, 2, F.size(places)).alias("next")), statistics)

    def statistics(t):
        n, half = t["n"], (t["k"] - 1) / 2
        total = lambda values: F.aggregate(values, F.lit(0.0), lambda a, v: a + v)
        mean = total(t["x"]) / n
        high = F.size(F.filter(t["x"], lambda v: v > half)).cast("double")
        turns = F.size(F.filter(F.arrays_zip(F.slice(t["x"], 1, F.size(t["next"])).alias("a"), t["next"].alias("b")),
                                lambda p: (p["a"] > half) != (p["b"] > half))).cast("double")
        return _let(F.struct(t["name"].alias("name"), t["even"].alias("even"), n.alias("n"), t["k"].alias("k"), t["chi"].alias("chi"),
                             t["x"].alias("x"), t["next"].alias("next"), mean.alias("mean"), high.alias("high"), (turns + 1).alias("runs")), p_values)

    def p_values(t):
        n, free = t["n"], t["k"] - 1
        total = lambda values: F.aggregate(values, F.lit(0.0), lambda a, v: a + v)
        hilferty = (F.pow(t["chi"] / free, F.lit(1 / 3)) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
        expected = 2 * t["high"] * (n - t["high"]) / n + 1
        spread = F.sqrt(F.greatest(F.lit(1e-9), (expected - 1) * (expected - 2) / (n - 1)))
        both = total(F.zip_with(F.slice(t["x"], 1, F.size(t["next"])), t["next"], lambda a, b: (a - t["mean"]) * (b - t["mean"])))
        own = F.greatest(F.lit(1e-9), total(F.transform(t["x"], lambda v: (v - t["mean"]) * (v - t["mean"]))))
        p = F.least(1 - _phi(hilferty), 2 * (1 - _phi(F.abs(t["runs"] - expected) / spread)), 2 * (1 - _phi(F.abs(both / own) * F.sqrt(n))))
        bend = n * (t["k"] * t["even"] - 1)
        p_text = _phi((t["chi"] - free - bend) / F.sqrt(2 * free + 4 * bend))
        # Digits of a number are as even as random ones: nothing rules text out.
        return F.struct(t["name"].alias("encoding"), F.least(F.lit(1.0), 3 * p).alias("p_random"),
                        F.when(bend > 0, p_text).otherwise(1.0).alias("p_text"))

    body = F.regexp_replace(run, "(.)=+$", "$1")
    return _let(body, lambda b: _let(F.struct(b.alias("body"), _encoding(b).alias("enc")), tests))


def _bin(p: Column) -> Column:
    """The bin of a p-value: its upper end is 10 ** (-bin / BINS_PER_DECADE)."""
    return F.floor(-F.log10(F.greatest(F.lit(LEAST_P), F.least(F.lit(1.0), p))) * BINS_PER_DECADE).cast("int")


def _band(length: Column) -> Column:
    out = F.lit(0)
    for k, low in enumerate(BANDS):
        out = F.when(length >= low, k).otherwise(out)
    return out


def thresholds(bins: list[tuple[int, int, int]], q: float) -> dict[int, int]:
    """Band -> smallest bin that Benjamini-Hochberg rejects, from (band, bin,
    count) rows. Bands without a rejection are left out."""
    out = {}
    for band in {b for b, _, _ in bins}:
        own = sorted(((x, n) for b, x, n in bins if b == band), reverse=True)
        m, seen = sum(n for _, n in own), 0
        for x, n in own:
            seen += n
            if 10 ** (-x / BINS_PER_DECADE) <= q * seen / m:
                out[band] = x
    return out


def scan(docs: DataFrame, q: float = 0.05, least_random: float = 0.001, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, found): spans (s, k, e) of every text by start, then kind
    (k: 0 assign, 1 access, 2 hex, 3 random). ``matched`` gives their texts.

    Null and empty texts have no spans. Random spans that touch a base span
    are left out. Repeated rows and null ids give a row each; an empty table an
    empty table; other columns are ignored. In one text the spans of a kind
    never overlap. No text of a match is written anywhere: the table between
    holds offsets, and of key-like runs a digest that tells different ones apart.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    t = F.col("text")
    named = t.rlike("(?i)password|passwd|secret|token|api_?key")
    offsets = lambda spans: F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))
    parts = {
        "assign": offsets(F.filter(_spans(t, ASSIGN, named), lambda x: F.length(F.regexp_extract(x["v"], ASSIGN, 2)) >= 8)),
        "access": offsets(F.filter(_spans(t, ACCESS, t.contains("AKIA")), lambda x: x["e"] - x["s"] >= 16)),
        # maximal runs, so runs of 32 and more are the same spans
        "hex": offsets(_spans(t, "[0-9a-f]{32,}", t.rlike("[0-9a-f]{32}"))),
        "run": F.transform(_spans(t, RUN, t.rlike(RUN)), lambda x: F.struct(
            x["s"].alias("s"), x["e"].alias("e"), F.unhex(F.sha2(x["v"], 256)).alias("digest"), battery(x["v"]).alias("b"))),
    }
    found = staged(rows.select("doc_id", *(c.alias(name) for name, c in parts.items())), "spans")
    length = lambda x: x["e"] - x["s"]
    each = found.select(F.explode("run").alias("r")).select("r.digest", _band(length(F.col("r"))).alias("band"), _bin(F.col("r.b.p_text")).alias("bin"))
    table = each.distinct().groupBy("band", "bin").agg(F.count(F.lit(1)).alias("n")).collect()  # bands times bins at most
    limit = thresholds([tuple(r) for r in table], q)
    passed = lambda x: F.coalesce(*(F.when(_band(length(x)) == band, _bin(x["b"]["p_text"]) >= least) for band, least in limit.items()), F.lit(False))
    tagged = lambda spans, k: F.transform(spans, lambda x: F.struct(x["s"].alias("s"), F.lit(k).alias("k"), x["e"].alias("e")))
    random = F.filter("run", lambda x: (x["b"]["p_random"] >= least_random) & passed(x) & ~(
        _touched(F.col("assign"), x) | _touched(F.col("access"), x) | _touched(F.col("hex"), x)))
    return found.select("doc_id", F.array_sort(F.concat(
        tagged("assign", 0), tagged("access", 1), tagged("hex", 2), tagged(random, 3))).alias("found"))


def matched(text: Column, found: Column) -> Column:
    """The texts of ``found`` spans, in their order."""
    return F.transform(found, lambda x: F.substring(text, x["s"] + 1, x["e"] - x["s"]))


def _joined(spans: Column) -> Column:
    name = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", name[x["k"]], x["s"], x["e"])), ",")


def report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random."""
    out = scan(docs, **options)
    count = lambda k: F.size(F.filter("found", lambda x: x["k"] == k)).cast("long")
    return out.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                      F.sha2(_joined(F.filter("found", lambda x: x["k"] < 3)), 256).alias("base_sha256"),
                      _joined(F.col("found")).alias("spans"), count(3).alias("n_random"))
