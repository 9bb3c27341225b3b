import random
import re
from collections import Counter

import pytest

import compare
from lakeops.llm import divergence, queries


def slow_audit(rows, least, top):
    """All rows of the audit over (lang, source, text), term by term."""
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(low)))
            for lang, source, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        holders = Counter(t for d in mine for t in set(d[2]))
        kept = {t for t, n in holders.items() if n >= least}
        sources = sorted({d[1] for d in mine})
        counts = {s: Counter(t for d in mine if d[1] == s for t in d[2] if t in kept) for s in sources}

        def chances(c):
            total = sum(c.values())
            return {t: 1 + 1_000_000_000 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: chances(c) for s, c in counts.items()}
        q = chances(sum(counts.values(), Counter()))
        for s in sources:
            parts = {"pair": [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s],
                     "term": [(t, p[s][t] - q[t]) for t in kept if counts[s][t] and p[s][t] > q[t]]}
            for part, items in parts.items():
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, n) for n, (i, v) in enumerate(items, 1) if part == "pair" or n <= top]
    return sorted(out)


def check(df, rows, least=30, top=50):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, df.collect())) == slow_audit(rows, least, top)


def read(df):
    return [tuple(r) for r in df.select("lang", "source", "text").collect()]


def test_query_on_the_given_table(spark, tiny):
    query = queries.QUERIES["op13_source_divergence"](spark, tiny)
    assert compare.differences(query, compare.connect(tiny), queries.ORACLES["op13_source_divergence"]) == ""
    check(query, read(spark.read.parquet(f"{tiny}/documents.parquet")))


@pytest.fixture(scope="module")
def mixed(spark):
    """Many sources of uneven size, a hot one, NULLs, empty texts, copies, one very long text, terms outside ASCII."""
    rng = random.Random(8)
    words = ["Alpha", "beta", "GAMMA", "straße", "Été", "漢字", "x", "İ", "naïve-te", "one2two", "z_z", "a b"]
    words += [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(150)]
    rows = []
    for i in range(400):
        lang = rng.choice(["en", "en", "en", "de", None, ""])
        source = rng.choice(["hot"] * 10 + [f"s{k}" for k in range(25)] + [None])
        weights = [1 + (hash_of(source, w) % 7) for w in words]
        rows.append((lang, source, " ".join(rng.choices(words, weights, k=rng.randrange(0, 40)))))
    rows += [("en", "hot", "copy of copies")] * 60 + [("en", "silent", None), ("en", "numbers", "1 2 3"), ("fr", "alone", "un")]
    rows += [("en", "long", "alpha Beta " * 250_000 + "漢字" * 5000 + " w" * 9)]
    return rows


def hash_of(*values):
    return random.Random(repr(values)).randrange(1000)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "clash", 2) for r in rows],
                                 "lang string, source string, text string, run int, term string, p int")


@pytest.mark.parametrize("least,top", [(5, 50), (30, 3), (10_000, 50)])
def test_awkward_rows(spark, mixed, least, top):
    check(divergence.audit(frame(spark, mixed).repartition(3), min_documents=least, top=top), mixed, least, top)


def test_many_runs_and_merge_levels(spark, mixed):
    docs = frame(spark, mixed).repartition(9)
    runs = divergence.index_runs(docs.select("lang", "source", "text").fillna(""), block_postings=150)
    assert runs.select("run").distinct().count() == 9
    check(divergence.audit(docs, min_documents=5, block_postings=150, fan_in=3, shards=4), mixed, 5)


def test_long_texts_are_cut_between_terms(spark, mixed, monkeypatch):
    text = ("alpha Beta " * 900 + "漢字" * 3000 + " w1w " * 9).encode()
    monkeypatch.setattr(divergence, "PIECE_BYTES", 1000)
    block = divergence.Block()
    other = b"beta beta "
    block.add([("en", "a")], divergence.np.frombuffer(text, divergence.np.uint8), divergence.np.array([0, len(text)]))
    block.add([("en", "a"), ("en", "b")], divergence.np.frombuffer(other, divergence.np.uint8),
              divergence.np.array([0, 5, 10]))
    counts = block.counts()
    found = {(counts.terms[t].as_py().decode(), counts.groups[g][1]): (n, d)
             for t, g, n, d in zip(counts.term, counts.group, counts.n, counts.docs)}
    assert found == {("", "a"): (0, 2), ("", "b"): (0, 1), ("alpha", "a"): (900, 1), ("beta", "a"): (901, 2),
                     ("beta", "b"): (1, 1), ("漢字" * 3000, "a"): (1, 1), ("w", "a"): (18, 1)}


def test_more_sources_than_a_table_holds(spark, mixed, monkeypatch):
    monkeypatch.setattr(divergence, "TABLE_SOURCES", 8)
    held = [(lang, names) for lang, names in (("en", list("abcdefghijklm")), ("en", list("kxyz")), ("de", list("ab")),
                                              ("en", list("pqrstuv")), ("de", list("bcdefghi")))]
    import pyarrow as pa
    rng, rows, want = random.Random(1), [], Counter()
    for lang, names in held:
        cells = [{"source": n, "p": rng.randrange(1000), "base": ord(n)} for n in names]
        rows.append({"lang": lang, "held": cells})
        for a in cells:
            for b in cells:
                if a is not b:
                    want[lang, a["source"], b["source"]] += (
                        abs(a["p"] - b["p"]) - abs(a["p"] - b["base"]) - abs(a["base"] - b["p"]) + abs(a["base"] - b["base"]))
    found = Counter()
    for batch in divergence._corrections(iter([pa.RecordBatch.from_pylist(rows)])):
        for r in batch.to_pylist():
            found[r["lang"], r["source"], r["item"]] += r["value"]
    assert {k: v for k, v in found.items() if v} == {k: v for k, v in want.items() if v}


def test_empty_table(spark, mixed):
    assert divergence.audit(frame(spark, mixed).limit(0)).collect() == []


def test_counts_beyond_32_bits_stay_exact(spark):
    row = spark.range(1).select(divergence.chance(*[divergence.F.lit(x).cast("long") for x in (
        8 * 10 ** 17, 9 * 10 ** 17, 10 ** 9)]).alias("p")).first()
    assert row.p == 1 + 10 ** 9 * (8 * 10 ** 17 + 5) // (9 * 10 ** 17 + 5 * 10 ** 9)
