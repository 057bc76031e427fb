import hashlib

from tessera.llm import fingerprint
from tessera.llm.fingerprint import fingerprints, with_next

from tests.llm.conftest import words


def pieces(text):
    out = set()
    for k, line in enumerate(text.split("\n")):
        w = line.split()
        at, n = 0, 4 if k == 0 else 32
        while at < len(w):
            out.add(" ".join(w[at : at + n]))
            at, n = at + n, min(32, n * 2)
    return out


def likeness(a, b):
    a, b = pieces(a), pieces(b)
    return 1.0 if not a and not b else 1 - len(a ^ b) / (len(a) + len(b))


def check(rows, got):
    rows = sorted(rows, key=lambda r: r[0])
    by = {r["doc_id"]: r for r in got}
    prints = {}
    for k, (i, t) in enumerate(rows):
        t, nxt = t or "", rows[(k + 1) % len(rows)][1] or ""
        q = len(t) // 4
        edited = t[: len(t) - q] + nxt[:q]
        g = by[i]
        assert g["n_chars"] == len(t) and g["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(g["near_edited"] - likeness(t, edited)) < 1e-9 and abs(g["near_next"] - likeness(t, nxt)) < 1e-9
        for text, p in ((t, g["fingerprint"]), (edited, g["edited_fingerprint"])):
            assert prints.setdefault(text, p) == p and p.startswith(f"{len(pieces(text))}:")
    assert len(set(prints.values())) == len({frozenset(pieces(t)) for t in prints})


def test_equals_brute_force(spark):
    rows = []
    for i in range(150):
        w = words(i // 2 if i % 5 == 0 else i, (i * 7) % 400, 5000)
        rows.append((i * 3 + (i % 2), "\n".join(" ".join(w[k : k + 60]) for k in range(0, len(w), 60))))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    check(rows, fingerprints(df).collect())


def test_odd_rows(spark, odd_docs, no_docs):
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    unique = dict((i, t) for i, t in docs if i is not None)
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in unique.items()], "doc_id long, text string, digests int, e string")
    check(list(unique.items()), fingerprints(df).collect())
    assert fingerprints(odd_docs).count() == len(docs)
    assert fingerprints(no_docs).count() == 0
    one = fingerprints(spark.createDataFrame([(4, "only one text here")], "doc_id long, text string")).first()
    assert one["near_next"] == 1.0


def test_next_rows_cross_ranges(spark):
    rows = [(i * i, f"t{i}") for i in range(-40, 200) if i >= 0 or i % 2]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["text"]): (r["next_text"]) for r in with_next(df).collect()}
    ids = sorted(i for i, _ in rows)
    assert len(got) == len(rows)
    by_id = {}
    for i, t in rows:
        by_id.setdefault(i, set()).add(t)
    for (i, t), nxt in got.items():
        later = [x for x in ids if x > i]
        assert nxt in by_id[i] | by_id[later[0] if later else ids[0]]


def test_two_strings_are_enough(spark):
    """near_* once more, from the returned strings only, written out and read again; and each string gives back its pieces."""
    rows = [(i, "\n".join(" ".join(words(i // 2 * 50 + k, 45, 3000)) for k in range((i * i) % 90))) for i in range(60)] + [(100, "x"), (101, None)]
    got = fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    stored = [(r["fingerprint"], r["edited_fingerprint"], got[(k + 1) % len(got)]["fingerprint"], r["near_edited"], r["near_next"]) for k, r in enumerate(got)]
    again = spark.createDataFrame(stored, "a string, e string, n string, x double, y double").select(fingerprint.likeness("a", "e").alias("e"), fingerprint.likeness("a", "n").alias("n"), "x", "y").collect()
    assert all(r["e"] == r["x"] and r["n"] == r["y"] for r in again)
    sets = spark.createDataFrame([(r["fingerprint"],) for r in got], "f string").selectExpr(f"transform(array(split(f, ':')), ps -> {fingerprint._digests_of('ps', fingerprint._longs('ps[1]'))})[0] as d").collect()
    assert [len(set(r["d"])) for r in sets] == [len(pieces(t or "")) for _, t in sorted(rows)]
    assert any(":" in r["fingerprint"][800:] for r in got)


def test_tables_that_cannot_be_emptied_hold_their_digests(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "SALTS", 1)
    monkeypatch.setattr(fingerprint, "LOAD", 64)  # too many for a table
    rows = [(i, " ".join(words(i // 2, 6000, 5000))) for i in range(4)] + [(9, " ".join(words(9, 6000, 5000)[:4000] + words(1, 2000)))]
    got = fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    check(rows, got)
    assert all(r["near_edited"] > 0 and ":=" in r["fingerprint"] for r in got)
