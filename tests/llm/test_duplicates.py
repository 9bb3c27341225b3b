import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

import compare
from lakeops.llm import decontaminate, line_windows, queries, simhash, suffixes
from lakeops.llm.components import component_roots


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


# -- SimHash ---------------------------------------------------------------------------------------------------------

def slow_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", low(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def check_components(rows, texts):
    """``rows`` of near_duplicates against the brute-force version over (id, text)."""
    prints = [slow_print(t) for _, t in texts]
    roots = slow_components(prints)
    least = {}
    for (i, _), root in zip(texts, roots):
        if i is not None:
            least[root] = min(i, least.get(root, i))
    want = sorted((str(i), f"{p:016x}", str(least.get(r))) for (i, _), p, r in zip(texts, prints, roots))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in rows) == want


def test_simhash_of_the_given_table(spark, tiny):
    texts = [tuple(r) for r in spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text").collect()]
    check_components(queries.QUERIES["op3_simhash_components"](spark, tiny).collect(), texts)


def test_simhash_of_awkward_rows(awkward, no_documents):
    texts = [tuple(r) for r in awkward.select("doc_id", "text").collect()]
    check_components(simhash.near_duplicates(awkward).collect(), texts)
    assert simhash.near_duplicates(no_documents).collect() == []


def test_long_text_in_blocks(monkeypatch):
    text = " ".join(random.Random(3).choices(["a", "b", "Cc", "ddd"], k=500))
    monkeypatch.setattr(simhash, "_BLOCK", 7)
    assert simhash.fingerprint(text) == slow_print(text)


@pytest.mark.parametrize("cell_rows", [3, 4096])
def test_links_connect_all_prints_within_two_bits(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(simhash, "CELL_ROWS", cell_rows)  # full cells are split by equal bits; same components
    rng = random.Random(6)
    prints = [rng.getrandbits(64) for _ in range(60)]
    for _ in range(400):
        prints.append(rng.choice(prints) ^ (1 << rng.randrange(64)) ^ (rng.random() < 0.7) * (1 << rng.randrange(64)))
    signed = np.array(sorted(set(prints)), np.uint64).view(np.int64).tolist()
    links = simhash.print_links(spark.createDataFrame([(p,) for p in signed], "print long"), "print")
    assert links.count() < 40 * len(signed)
    roots = {r.node: r.root for r in component_roots(links).collect()}
    unsigned = [p & (1 << 64) - 1 for p in signed]
    want = slow_components(unsigned)
    got = [roots.get(p, p) for p in signed]
    assert len(set(zip(want, got))) == len(set(want)) == len(set(got))


def test_components_of_long_paths(spark):
    pairs = [(i, i + 1) for i in range(300)] + [(1000 + i, 1000) for i in range(1, 50)] + [(5, 5)]
    random.Random(0).shuffle(pairs)
    roots = {r.node: r.root for r in component_roots(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert roots == {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(50)}


def test_one_document_of_each_group_stays(awkward, no_documents):
    kept = simhash.keep_first(awkward)
    assert kept.columns == awkward.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    first = sorted({r.component_id for r in simhash.near_duplicates(awkward).collect() if r.component_id})
    assert ids == first
    assert simhash.keep_first(no_documents).count() == 0


# -- lines -----------------------------------------------------------------------------------------------------------

def slow_lines(rows, span=3):
    seen, out = {}, []
    places = sorted({(i is not None, i or 0, t) for i, t in rows if t is not None}, key=lambda p: p[:2])
    for place in places:
        lines = place[2].split("\n")
        for k in range(len(lines) - span + 1):
            if "".join(lines[k:k + span]).strip(" "):
                seen.setdefault(tuple(lines[k:k + span]), (place, k))
    for i, t in rows:
        lines, gone = (t.split("\n") if t is not None else []), set()
        for k in range(len(lines) - span + 1):
            first = seen.get(tuple(lines[k:k + span]))
            if first and first != ((i is not None, i or 0, t), k):
                gone |= set(range(k, k + span))
        kept = "\n".join(x for k, x in enumerate(lines) if k not in gone)
        out.append((str(i), len(lines), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def test_lines_of_awkward_rows(awkward, no_documents):
    rows = [tuple(r) for r in awkward.select("doc_id", "text").collect()]
    got = sorted((str(r.doc_id), r.n_lines, r.n_removed, r.kept_sha256) for r in line_windows.report(awkward).collect())
    assert got == slow_lines(rows)
    assert line_windows.drop_repeats(awkward).columns == awkward.columns
    assert line_windows.drop_repeats(awkward).count() == len(rows)
    assert line_windows.report(no_documents).collect() == []


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_agree_with_sql(spark, tiny, name):
    assert compare.differences(queries.QUERIES[name](spark, tiny), compare.connect(tiny), queries.ORACLES[name]) == ""


def test_lines_use_no_python(spark, awkward):
    plan = line_windows.report(awkward)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_first_of_each_component_with_a_clashing_column(spark):
    docs = spark.createDataFrame([(1, "a b c d", 7), (2, "a b c d", 8), (3, "other words than these", 9)],
                                 "doc_id long, text string, _first int")
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect())) == [
        (1, "a b c d", 7), (3, "other words than these", 9)]


# -- byte strings ----------------------------------------------------------------------------------------------------

def test_suffix_order_and_common_prefixes():
    rng = random.Random(3)
    for _ in range(20):
        strings = [bytes(rng.choices(b"abc", k=rng.randint(1, 12))) for _ in range(20)]
        owner, depth, common = suffixes.suffix_order(strings, 5)
        found = [strings[a][len(strings[a]) - b:] for a, b in zip(owner.tolist(), depth.tolist())]
        assert found == sorted(found) and len(found) == sum(map(len, strings)) + len(strings)
        for one, two, prefix in zip(found, found[1:], common[1:].tolist()):
            shared = next((i for i, (a, b) in enumerate(zip(one, two)) if a != b), min(len(one), len(two)))
            assert prefix == min(5, shared)


def slow_bytes(rows):
    first = {}
    for i, t in rows:
        raw = (t or "").encode()
        for k in range(len(raw) - 49 if i is not None else 0):
            first[raw[k:k + 50]] = min(i, first.get(raw[k:k + 50], i))
    out = []
    for i, t in rows:
        raw = (t or "").encode()
        gone = np.zeros(len(raw) + 2, bool)
        for k in range(len(raw) - 49 if i is not None else 0):
            if first[raw[k:k + 50]] < i:
                gone[k + 1:k + 51] = True
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone[1:-1]])
        out.append((str(i), len(raw), int(gone.sum()), int((gone[1:] > gone[:-1]).sum()),
                    hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_bytes_of_awkward_rows(awkward, no_documents):
    rows = [tuple(r) for r in awkward.select("doc_id", "text").collect()]
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
                 for r in suffixes.report(awkward).collect())
    assert got == slow_bytes(rows)
    assert suffixes.report(no_documents).collect() == []
    assert suffixes.drop_repeats(awkward).columns == awkward.columns


def test_bytes_of_the_given_table_in_small_chunks(spark, tiny, monkeypatch):
    for name, value in (("CHUNK_BYTES", 50_000), ("HASHED_BYTES", 3000), ("BUCKET_BYTES", 40_000), ("ORDER_BYTES", 5000)):
        monkeypatch.setattr(suffixes, name, value)
    table = spark.read.parquet(f"{tiny}/documents.parquet")
    rows = [tuple(r) for r in table.select("doc_id", "text").collect()]
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
                 for r in suffixes.report(table).collect())
    assert got == slow_bytes(rows)


# -- benchmark windows -----------------------------------------------------------------------------------------------

def test_rows_that_repeat_a_key_keep_their_own_text(spark):
    rng = random.Random(12)
    a, b, c = ("".join(rng.choices("abcdefgh ", k=108)) for _ in range(3))
    rows = [(1, a), (2, a), (2, b), (2, b), (2, a + c), (3, c), (None, a), (3, None), (3, b + "x" + c)]
    rows += [(5, "".join(rng.choices("abcdefgh ", k=70))) for _ in range(40)] + [(6, a[:60] + rng.choice("xyz")) for _ in range(9)]
    docs = spark.createDataFrame([(i, t, 9, 8) for i, t in rows], "doc_id int, text string, variant int, `of` int")
    found = suffixes.report(docs.repartition(4))
    assert dict(found.dtypes)["doc_id"] == "int"
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found.collect()) == slow_bytes(rows)
    left = suffixes.drop_repeats(docs)
    assert left.columns == docs.columns
    assert sorted((str(r.doc_id), len((r.text or "").encode())) for r in left.collect()) == sorted(
        (i, n - gone) for i, n, gone, _, _ in slow_bytes(rows))
    with pytest.raises(ValueError, match="whole numbers"):
        suffixes.report(docs.withColumn("doc_id", docs["doc_id"].cast("string")))


def test_groups_of_one_string_need_no_order():
    rng = random.Random(3)
    strings = [bytes(rng.choices(b"ab", k=rng.randrange(50, 80))) for _ in range(60)]
    tag = np.sort(np.array([rng.randrange(40) for _ in strings], np.uint64))
    least = np.array([rng.randrange(30) for _ in strings])
    found = suffixes._smallest(strings, tag, least, 50)
    for i, one in enumerate(strings):
        for k in range(len(one) - 49):
            window = one[k:k + 50]
            want = min(d for s, t, d in zip(strings, tag, least) if t == tag[i] and window in s)
            # Groups that share a window share its least part; here groups are drawn, so other groups may lower it.
            assert min(least) <= found[i][k] <= want


def slow_windows(documents, items):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text or ""))

    windows = {}
    for item, text in items:
        got = words(text)
        size = min(13, len(got))
        for k in range(len(got) - size + 1 if size else 0):
            windows.setdefault(tuple(got[k:k + size]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for i, text in documents:
        got, hit, names = words(text), set(), set()
        for size in sizes:
            for k in range(len(got) - size + 1):
                if tuple(got[k:k + size]) in windows:
                    hit |= set(range(k, k + size))
                    names |= windows[tuple(got[k:k + size])]
        out.append((str(i), len(got), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(got)))
    return sorted(out)


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_BYTES, 1500])
def test_benchmark_windows(spark, awkward, no_documents, limit):
    texts = [tuple(r) for r in awkward.select("doc_id", "text").collect()]
    long = texts[0][1].split(" ")
    items = [(1, " ".join(long[10:40])), (2, "X"), (3, "one two"), (4, None), (5, ""), (5, " ".join(long[30:44])),
             (6, "Two: THREE, four")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.report(awkward, benchmark, broadcast_bytes=limit)
    rows = sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got.collect())
    assert rows == slow_windows(texts, items)
    assert decontaminate.report(no_documents, benchmark).collect() == []
    assert {r.n_hit for r in decontaminate.report(awkward, benchmark.limit(0)).collect()} == {0}


def test_benchmark_spans_are_cut_out(spark):
    docs = spark.createDataFrame([(1, "Keep this. A b c, d! And that.", 5), (2, None, 6), (3, "a b c d", 7)],
                                 "doc_id long, text string, hits int")
    benchmark = spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    cut = decontaminate.decontaminate(docs, benchmark, "spans")
    assert cut.columns == docs.columns
    assert {r.doc_id: r.text for r in cut.collect()} == {1: "Keep this. ! And that.", 2: None, 3: ""}
    assert {r.doc_id for r in decontaminate.decontaminate(docs, benchmark).collect()} == {2}


def test_benchmark_of_the_given_tables(spark, tiny):
    read = lambda n: [tuple(r) for r in spark.read.parquet(f"{tiny}/{n}.parquet").select(
        "doc_id" if n == "documents" else "item_id", "text").collect()]
    rows = queries.QUERIES["op10_decontamination"](spark, tiny).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows) == \
        slow_windows(read("documents"), read("benchmark"))
