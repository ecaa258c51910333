import hashlib
import random
import re

from lakeloom.llm import secrets

PATTERNS = [re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
            re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+")]
HEX, B64 = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def base(text):
    spans = []
    for k, p in enumerate(PATTERNS):
        for m in p.finditer(text or ""):
            if len(m.group(2)) >= 8 if k == 0 else len(m.group()) >= (16, 32)[k - 1]:
                spans.append((m.start(), k, m.end()))
    spans.sort()
    named = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in spans)
    return (*(sum(x == k for _, x, _ in spans) for k in range(3)), hashlib.sha256(named.encode()).hexdigest())


def report(spark, rows):
    return secrets.report(spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, spans string")).collect()


def test_base_spans(spark):
    rng = random.Random(6)
    pieces = ["token", "Token", "API_KEY", "apikey", "secret", "passwd", "password", ":", "=", " ", "  ", '"', "'", "AKIA", "AKIAABCDEFGH", "IJKL1234", "é", "\n",
              "abcdefgh", "x.y-z_1/2+3", "0123456789abcdef", "0123456789abcdef" * 2, "ABC", "日本", "."]
    rows = [(i, "".join(rng.choice(pieces) for _ in range(rng.randrange(40)))) for i in range(400)]
    rows += [(900, None), (901, ""), (None, "token=abcdefgh12"), (902, "token=abcdefgh12"), (902, "token=abcdefgh12"), (903, "word " * 60_000 + "secret: abcdefgh99"),
             (904, "f" * 5000), (905, "token:token:abcdefghijkl token=secret=abcdefghij")]
    got = report(spark, rows)
    key = lambda r: repr(r)
    assert sorted(((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got), key=key) == sorted(((i, *base(t)) for i, t in rows), key=key)
    assert all(r.spans.count("assign:") == r.n_assign for r in got)


def test_random_runs_are_found_and_words_are_not(spark):
    rng = random.Random(8)
    strange = ["".join(rng.choice(B64[:62]) for _ in range(48)) for _ in range(30)]
    plain = ["Donaudampfschifffahrtsgesellschaft", "internationalizationandlocalization", "src/main/java/org/example/application", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa",
             "20240101123000202401011230002024", "some-long-name-with-dashes-in-between", "------------------------------", "abababababababababababababababab"]
    rows = [(k, f"see {v} there") for k, v in enumerate(strange)] + [(100 + k, f"see {v} there") for k, v in enumerate(plain)]
    got = {r.doc_id: r for r in report(spark, rows)}
    found = sum(got[k].n_random for k in range(30))
    assert found >= 24 and all(got[k].spans in ("", "random:4:52") for k in range(30))
    assert [k for k in range(100, 108) if got[k].n_random] == []


def test_battery_statistics(spark):
    text = "9f8A7b6C5d4E3f2A1b0C9f8A7b"
    r = spark.range(1).select(secrets.battery(secrets.F.lit(text)).alias("b")).first().b
    assert r.encoding == "base62" and 0 <= r.p_random <= 1 and 0 <= r.p_text <= 1
    for text, name in [("1234", "digits"), ("beef01", "hex"), ("BEEF01", "hex upper"), ("word", "lower"), ("XYZ234", "base32"), ("a+b/C1==", "base64"), ("a-b_C", "base64url"), ("a-b/c", "mixed")]:
        assert spark.range(1).select(secrets.battery(secrets.F.lit(text))["encoding"]).first()[0] == name


def test_thresholds_are_benjamini_hochberg():
    # p = 10 ** (-bin / 50): bins 100, 60, 10 are 0.01, 0.063, 0.63
    assert secrets.thresholds([(0, 100, 5), (0, 10, 5)], 0.05) == {0: 100}
    assert secrets.thresholds([(0, 100, 1), (0, 10, 9)], 0.05) == {}
    assert secrets.thresholds([(0, 100, 1), (1, 100, 1)], 0.05) == {0: 100, 1: 100}


def test_empty_table(spark):
    assert report(spark, []) == []


def test_many_matches_in_one_text(spark):
    # over several blocks of matches, of two kinds that touch runs
    text = " ".join(f"token={k:012d}é {k:032x}" for k in range(700))
    r, = report(spark, [(1, text)])
    assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256) == base(text) and r.n_random == 0


def test_matched_texts_are_in_no_stored_table(spark, monkeypatch):
    key = "zQ7Lm2Xv9Tb4Rk8Ws1Nc6Yp3Hd5Fg0Ja7Ue2Bi9Do4Sx"
    docs = spark.createDataFrame([(1, f"é password = {key[:20]} then {key}")], "doc_id long, text string")
    kept = []
    write = secrets.staged
    monkeypatch.setattr(secrets, "staged", lambda df, name: kept.append(write(df, name)) or kept[-1])
    out = secrets.scan(docs).join(docs, "doc_id").select(secrets.matched(secrets.F.col("text"), secrets.F.col("found")).alias("m")).first().m
    assert out[0] == f"password = {key[:20]}" and all(key[:20] not in str(r) for t in kept for r in t.collect())


def test_touched_by_binary_search(spark):
    rng = random.Random(3)
    F = secrets.F
    for _ in range(4):
        cuts = sorted(rng.sample(range(100), 2 * rng.randrange(6)))
        spans = list(zip(cuts[::2], cuts[1::2]))
        runs = [(a, a + rng.randrange(1, 9)) for a in range(0, 100, 5)]
        df = spark.createDataFrame([(spans, runs)], "spans array<struct<s:int,e:int>>, runs array<struct<s:int,e:int>>")
        got = df.select(F.transform("runs", lambda x: secrets._touched(F.col("spans"), x))).first()[0]
        assert got == [any(s < e2 and s2 < e for s, e in spans) for s2, e2 in runs]
