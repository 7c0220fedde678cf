"""The corpus operators against brute force, round trips and their SQL, odd rows included."""

import glob
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from conftest import SF
from pagedframes.llm import decontaminate, exact, jaccard, lines, packing, quality, substring, token_counts, urls, warc
from pagedframes.llm.queries import ORACLE, QUERIES, RULES
from pagedframes.llm.tokens import Encoder, tokenizer_path

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, vertex int, score string, "
    "kept string, slot string, pos string, queue string, n string, lost string, root string, group_size string"
)


def frame(spark, texts, sources=None):
    """Documents with clashing extra columns, in several partitions."""
    rows = [
        (d, t, None, sources[k] if sources else None, None, "k", 7, "s", None, "x", "p", "q", "n", "l", "r", "g")
        for k, (d, t) in enumerate(texts)
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3) if rows else spark.createDataFrame([], SCHEMA)


LONG = " ".join(f"word{k % 977}x{k % 13}" for k in range(30_000))
ODD = [
    (1, None), (2, ""), (3, " \n\t"), (4, "one line only, of some length\nanother line that is long enough"),
    (5, "one line only, of some length\nx\n"), (6, "ONE line only, of some length \r\nanother  line that is long enough"),
    (7, LONG), (8, LONG), (9, "a b"), (10, "A  b"), (10, "A  b"), (None, "a b"), (None, None), (11, "é ü ß <|endoftext|> 漢字\x00"),
]


def norm(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


# --- SQL ---------------------------------------------------------------------------


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_matches_sql(spark, name):
    tables = duckdb.connect()
    for file in glob.glob(f"{SF}/*.parquet"):
        tables.execute(f"CREATE VIEW {os.path.basename(file).removesuffix('.parquet')} AS SELECT * FROM '{file}'")
    df, want = QUERIES[name](spark, SF), tables.execute(ORACLE[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(df.columns)
    rows = sorted(tuple(str(r[n]) for n in names) for r in df.collect())
    assert rows == sorted(tuple(map(str, r)) for r in want.fetchall())


def test_native_queries_run_no_python(spark):
    for name in ("op1_url_filter", "op4_exact_dedup", "op5_line_dedup"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


# --- native operators ----------------------------------------------------------------


def test_exact_copies(spark):
    docs, groups = frame(spark, ODD), defaultdict(list)
    for d, t in ODD:
        groups[norm(t)].append(d)
    want = []
    for d, t in ODD:
        held = groups[norm(t)]
        keep = min((x for x in held if x is not None), default=None)
        want.append((d, keep, len(held), d == keep))
    for options in ({}, {"capacity": 1}, {"capacity": 2, "key": lambda c: exact.F.length(c).cast("bigint")}):
        found = exact.find_copies(docs, **options)
        got = [(r.doc_id, r.keep_id, r.group_size, r.kept) for r in found.collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    kept = exact.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({w[0] for w in want if w[3]})


def test_colliding_texts_are_links_of_one_chain(spark):
    """All hashes equal: one owner tells the texts apart; copies are counted whether they are hot or not."""
    texts = [f"text {n % 7}  here" for n in range(700)]
    docs = frame(spark, list(enumerate(texts)))
    for key in (lambda c: exact.F.lit(5).cast("bigint"), exact.F.xxhash64):
        index = exact.build_index(docs, capacity=2, key=key)
        rows = index.entries.collect()
        assert sorted((r.keep_id, r.group_size) for r in rows) == [(n, 100) for n in range(7)]
        chain = sorted(r.link for r in rows)
        assert chain == (list(range(1, 8)) if len({r.key for r in rows}) == 1 else [1] * 7)
        assert all(len({r.bucket for r in rows if r.key == k}) == 1 for k in {r.key for r in rows})


def test_directory_doubles_only_where_it_must(spark):
    wide, near = (spark.range(1, n).select(exact.F.shiftleft("id", k).alias("key")) for n, k in ((64, 58), (12, 52)))
    keys = wide.union(near)
    slots, depth = exact.directory(keys, 8)
    rows = {r.slot: r for r in slots.collect()}
    assert depth > 3 and len({r.depth for r in rows.values()}) > 1


def test_line_dedup(spark):
    rows = [*ODD, (12, "another line that is long enough\nlast"), (13, None)]
    got = {(r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in lines.drop_repeated_lines(frame(spark, rows)).collect()}
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip("\t\n\x0b\x0c\r "))
    held = defaultdict(set)
    for d, t in rows:
        for x in (t or "").split("\n"):
            held[key(x)].add(d)
    last = {k: max((x for x in v if x is not None), default=None) for k, v in held.items() if len(k) >= 20 and len(v) >= 3}
    want = set()
    for d, t in rows:
        every = (t or "").split("\n")
        kept = [x for x in every if key(x) not in last or last[key(x)] == d]
        want.add((d, len(every), len(every) - len(kept), "\n".join(kept)))
    assert got == want


def test_url_rules_and_links(spark):
    link = '<a href="http://{}/x">'.format
    pages = [
        (1, "http://a.example.net/en/1", ""), (2, "https://x.net/de/", None), (3, "http://good.org/fr/1?x#y", link("near.io")),
        (4, "http://near.io/", link("far.io")), (5, "http://fan.io/p", link("x.net") + "<a HREF='//x.net'>"), (6, None, "x"),
        (7, "no scheme", link("x.net")), (8, "HTTP://WWW.Example.com/de/z", ""), (8, "http://far.io", ""), (None, "http://mixed.io/", link("x.net") + link("good.org")),
        (9, "http://xnet/", ""), (10, "://net/", ""),
    ]
    rows = urls.judge(spark.createDataFrame(pages, "page_id bigint, url string, html string"), RULES).collect()
    assert len(rows) == len(pages)
    by = {(r.page_id, r.host): r for r in rows}
    assert {k: (r.path, r.rule, r.verdict) for k, r in by.items()} == {
        (1, "a.example.net"): ("/en/1", "example.net/en/", "allow"), (2, "x.net"): ("/de/", "net/", "block"),
        (3, "good.org"): ("/fr/1", "org/fr/", "allow"), (4, "near.io"): ("/", None, "allow"), (5, "fan.io"): ("/p", None, "block"),
        (6, ""): ("", None, "allow"), (7, ""): ("", None, "allow"), (8, "www.example.com"): ("/de/z", "example.com/de/", "block"),
        (8, "far.io"): ("", None, "allow"), (None, "mixed.io"): ("/", None, "block"), (9, "xnet"): ("/", None, "allow"),
        (10, "net"): ("/", "net/", "block"),
    }
    # trust by a plain power iteration
    edges = {("good.org", "near.io"): 1, ("near.io", "far.io"): 1, ("fan.io", "x.net"): 2, ("mixed.io", "x.net"): 1, ("mixed.io", "good.org"): 1}
    seeds = {"good.org": 1.0}
    out, score = Counter(), dict(seeds)
    for (a, _), n in edges.items():
        out[a] += n
    for _ in range(60):
        flow = Counter()
        for (a, b), n in edges.items():
            flow[b] += score.get(a, 0) * n / out[a]
        score = {h: 0.85 * flow[h] + 0.15 * seeds.get(h, 0) for h in {*flow, *seeds}}
    for host in ("near.io", "far.io"):
        assert next(r.trust for r in rows if r.host == host) == pytest.approx(score[host], abs=1e-5)


def test_distrust_goes_any_number_of_links(spark):
    n = 130
    rows = [(k, f"http://h{k}.de/", f'<a href="http://h{k - 1}.de/">' if k > 1 else '<a href="http://bad.net/">') for k in range(1, n + 1)]
    pages = spark.createDataFrame([*rows, (0, "http://bad.net/", "")], "page_id bigint, url string, html string")
    judged = urls.judge(pages, RULES).select("page_id", "verdict", "distrust").collect()
    assert len(judged) == n + 1 and all(r.verdict == "block" and r.distrust > 0 for r in judged)


def test_warc_is_read_back_by_bytes(spark, monkeypatch):
    rows = [(k, f"http://h/{k}", random.Random(k).randbytes(3000).hex()) for k in range(60)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1)
    index = warc.write_archives(pages)
    monkeypatch.setattr(warc, "PIECE", 20_000)
    records = warc.read_records(index)
    assert records.rdd.getNumPartitions() >= 9
    assert {(r.page_id, bytes(r.payload).decode()) for r in records.collect()} == {(k, h) for k, _, h in rows}


def test_url_verdicts_do_not_go_by_size(spark):
    """Two hosts on the way to one blocked seed among many, whose other in-links come from a much larger host."""
    link = '<a href="http://{}/x">'.format
    for seeds, links in ((1, 1), (21, 1), (300, 700_000)):
        pages = [(k, f"http://s{k}.net/", "") for k in range(seeds)]
        pages += [(-1, "http://fan.io/", link("s0.net")), (-2, "http://far.io/", link("fan.io")), (-3, "http://off.io/", "")]
        table = spark.createDataFrame(pages, "page_id bigint, url string, html string")
        farm = spark.createDataFrame([(-4, "http://farm.io/", links)], "page_id bigint, url string, n int")
        html = urls.F.expr("repeat('<a href=//s0.net>', n)").alias("html")
        rows = urls.judge(table.unionByName(farm.select("page_id", "url", html)), RULES).collect()
        verdicts = {r.host: r.verdict for r in rows if r.page_id < 0}
        assert verdicts == {"fan.io": "block", "far.io": "block", "off.io": "allow", "farm.io": "block"}


# --- tokens ----------------------------------------------------------------------------


def test_ids_are_those_of_the_library():
    encoder, rng = Encoder(tokenizer_path()), random.Random(5)
    odd = ["".join(rng.choice(" \n\tab'.1sé\x1c漢Ⅷ🙂") for _ in range(14)) for _ in range(3000)]
    for text in [*odd, *(t for _, t in ODD if t), "don't  stop\n\n <|endoftext|>x", "  ", "\n x"]:
        assert encoder.packed(text) == encoder.whole(text), text


def test_packing_round_trip(spark):
    rng = random.Random(2)
    texts = [(d, " ".join(f"w{rng.randrange(50)}" for _ in range(rng.randrange(120)))) for d in range(120)] + ODD
    sources = [rng.choice(["big", "big", "small", None, "other"]) for _ in texts]
    docs = frame(spark, texts, sources)
    pieces = packing.pack(docs, tokenizer_path(), {"big": 2, "small": 1, "none": 1}, 1, length=64, window=4)
    rows = pieces.collect()
    encoder, want = Encoder(tokenizer_path()), Counter()
    for d, t in texts:
        want[d, tuple(encoder.ids(t).tolist()) + (0,)] += 1
    places = defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length and zlib.crc32(r.ids) == r.ids_crc32
        places[r.sequence_id].append((r.offset, r.length))
    total = sum(r.length for r in rows)
    assert total == sum(len(k[1]) * n for k, n in want.items())
    assert sorted(places) == list(range(-(-total // 64)))
    for k, held in places.items():
        held.sort()
        assert [o for o, _ in held] == [sum(n for _, n in held[:i]) for i in range(len(held))]
        assert sum(n for _, n in held) == (64 if k < max(places) else total - 64 * max(places))
    whole = defaultdict(dict)
    for r in rows:
        whole[r.doc_id].setdefault(r.start, []).append(tuple(np.frombuffer(r.ids, "<u4").tolist()))
    for (d, ids), n in want.items():
        if n == 1 and sum(k[0] == d for k in want) == 1:
            assert sum((v[0] for _, v in sorted(whole[d].items())), ()) == ids
    padded = packing.sequences(pieces, 64).collect()
    assert all(len(r.ids) == 4 * (r.used if r.used & (r.used - 1) == 0 else 64) for r in padded)


def test_windows_keep_the_mixture():
    plan = packing.Plan.of((10_000, 5_000, 300, 77), (5, 3, 2, 0), 64)
    seen = [set() for _ in plan.totals]
    taken = defaultdict(lambda: [0] * 4)
    for queue, n in enumerate(plan.totals):
        for start in range(0, n, 37):
            for at, size, sequence, offset in plan.pieces(queue, start, min(n, start + 37), 16):
                spots = {sequence * 16 + offset + i for i in range(size)}
                assert not spots & seen[queue] and offset + size <= 16 and at >= start
                seen[queue] |= spots
                for s in spots:
                    taken[s // 64][queue] += 1
    assert set.union(*seen) == set(range(sum(plan.totals))) and sum(map(len, seen)) == sum(plan.totals)
    held = np.cumsum([taken[w] for w in range(23)], 0)  # until the third queue runs out
    assert np.abs(held - np.outer(np.arange(1, 24) * 64, [0.5, 0.3, 0.2, 0])).max() <= 1


def test_token_limits(spark):
    encoder = Encoder(tokenizer_path())
    sizes = [len(encoder.ids(t)) for _, t in ODD]
    table = token_counts.limits(token_counts.length_histogram(frame(spark, ODD), tokenizer_path()))
    rows = table.collect()
    assert sorted(r.length for r in rows) == sorted(set(sizes))
    for r in rows:
        under = [s for s in sizes if s <= r.length]
        assert (r.documents, r.longer_documents, r.tokens) == (sizes.count(r.length), len(sizes) - len(under), sum(under))
        assert r.truncated_tokens == sum(min(s, r.length) for s in sizes) and r.all_tokens == sum(sizes)
        assert r.quantile == pytest.approx(len(under) / len(sizes))
    asked = spark.createDataFrame([(0,), (3,), (1000,), (10**7,)], "limit bigint")
    for r in token_counts.at_limits(table, asked).collect():
        assert r.truncated_tokens == sum(min(s, r.limit) for s in sizes)
        assert r.longer_documents == sum(s > r.limit for s in sizes)
    assert token_counts.quantile(table, 0.5).first()[0] == sorted(sizes)[(len(sizes) - 1) // 2]


# --- archives ----------------------------------------------------------------------------


def test_limits_asked_for_go_by_blocks(spark):
    rng = random.Random(6)
    sizes = [rng.choice([0, 7, rng.randrange(3000), 1024, 90_000]) for _ in range(400)]
    lengths = spark.createDataFrame(list(Counter(sizes).items()), "length bigint, documents bigint")
    wanted = [rng.randrange(100_000) for _ in range(200)] + [0, 0, 1023, 1024, 1025, 5000, 5000, 90_000, None]
    found = token_counts.at_limits(token_counts.limits(lengths), spark.createDataFrame([(w,) for w in wanted], "limit int"))
    got = Counter(tuple(r) for r in found.collect() if r["limit"] is not None)
    assert got == Counter((w, sum(s > w for s in sizes), sum(min(s, w) for s in sizes)) for w in wanted if w is not None)
    assert found.count() == len(wanted)
    # no window without partitions over what is asked
    assert not re.search(r"windowspecdefinition\(at#", found._jdf.queryExecution().executedPlan().toString())


def test_archives_round_trip(spark):
    big = "<p>" + "ü" * 600
    pages = [(1, "http://a/?q=%41 b\nc", big), (2, None, big), (3, "u", None), (4, "", "x"), (5, "v", "x"), (None, "w", big), (2, "z", big)]
    index = warc.write_archives(spark.createDataFrame(pages, "page_id bigint, url string, html string").repartition(2))
    assert {r.length > 0 for r in index.collect()} == {True}
    rows = warc.read_records(index).collect()
    got = Counter((r.page_id, r.url, r.record_type, r.refers_to, r.payload_bytes, r.payload and bytes(r.payload).decode()) for r in rows)
    revisit = lambda p, u: (p, u, "revisit", 2, len(big.encode()), None)
    response = lambda p, u, h: (p, u, "response", None, len((h or "").encode()), h or "")
    assert {k[:5] for k in got} == {
        x[:5] for x in (revisit(1, pages[0][1]), response(2, None, big), response(2, "z", big), response(3, "u", None),
                        response(4, "", "x"), response(5, "v", "x"), revisit(None, "w"))
    }
    assert warc.read_records(index.filter("page_id = 5"), payload=False).first().payload is None
    with pytest.raises(ValueError, match="damaged"):
        member = warc._record(1, "u", b"abc", "0" * 40, None, "response")
        warc.parse(warc.gzip.compress(member))


# --- benchmark ------------------------------------------------------------------------------


def plain_distance(pattern, text):
    """Least edits between the pattern and any part of the text."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for w in text:
        last, row[0] = row[0], 0
        for k, p in enumerate(pattern, 1):
            last, row[k] = row[k], min(row[k] + 1, row[k - 1] + 1, last + (p != w))
        best = min(best, row[-1])
    return best


def test_leaks_without_blanks_and_of_few_words(spark):
    han = "光合作用是植物利用阳光把二氧化碳和水变成养分并放出氧气的过程"
    edited = han.replace("养分", "食物")
    thai = "เมืองหลวงของประเทศไทยคือกรุงเทพมหานคร"
    items = [(1, han), (2, thai), (3, "photosynthesis converts radiation"), (4, "ab cd"), (5, "北京大学")]
    docs = [
        (11, f"问题：{han}。答案见下文，请看第三页"), (12, f"题目{edited}吗"), (13, f"คำถาม{thai}ครับ"), (14, "so photosynthesis converts radiation too"),
        (15, "x ab cd"), (16, "AB cd!"), (17, "我在北京大学读书"), (18, "北京大学"), (19, "photosynthesis converts all radiation"), (20, "阳光和水"),
    ]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = decontaminate.find_leaks(frame(spark, docs), bench).collect()
    found = {(r.doc_id, r.item_id, r.distance) for r in rows}
    assert found == {(11, 1, 0), (12, 1, 2), (13, 2, 0), (14, 3, 0), (16, 4, 0), (18, 5, 0)} and len(rows) == 6
    at = {r.doc_id: (r.start, r.stop) for r in rows}
    assert at[11] == (2, 2 + len(han)) and at[14] == (1, 4)
    assert {r.doc_id for r in decontaminate.clean(frame(spark, docs), bench).collect()} == {15, 17, 19, 20}


def test_leaks_match_brute_force(spark):
    rng = random.Random(4)
    word = lambda: rng.choice("abcdefghij")
    items = [(k, " ".join(word() for _ in range(rng.randrange(1, 25)))) for k in range(25)] + [(90, None), (91, "?!"), (None, "a b c d e f g")]
    docs = list(ODD)
    for k in range(60):
        held = [word() for _ in range(rng.randrange(60))]
        if k % 2:
            copy = decontaminate.words(rng.choice(items)[1])
            for _ in range(rng.randrange(4)):
                if copy:
                    copy[rng.randrange(len(copy))] = word()
            held[10:10] = copy
        docs.append((100 + k, " ".join(held).upper()))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = set()
    for d, t in docs:
        held = decontaminate.words(t)
        for i, text in items:
            pattern = decontaminate.words(text)
            short = len(pattern) < decontaminate.MIN_WORDS
            if pattern and (held == pattern if short else plain_distance(pattern, held) <= len(pattern) // 5):
                want.add((d, i))
    for size in (1 << 22, 150):
        rows = decontaminate.find_leaks(frame(spark, docs), bench, block_chars=size).collect()
        assert {(r.doc_id, r.item_id) for r in rows} == want
        for r in rows:
            assert r.distance <= r.item_words // 5 and 0 <= r.start < r.stop
    clean = decontaminate.clean(frame(spark, docs), bench)
    assert Counter(r.doc_id for r in clean.collect()) == Counter(d for d, _ in docs if d not in {w[0] for w in want})


# --- similar documents ------------------------------------------------------------------------


def brute_groups(rows, n, percent):
    sets, parent = defaultdict(list), {}
    for d, t in rows:
        held = (t or "").encode().lower().split()
        sets[d].append({tuple(held[k : k + n]) for k in range(max(1, len(held) - n + 1))} if held else set())
        parent[d] = d

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = [d for d in sets if d is not None]
    for a in ids:
        for b in ids:
            for x in sets[a]:
                for y in sets[b]:
                    if a < b and x and 100 * len(x & y) >= percent * len(x | y):
                        u, v = root(a), root(b)
                        parent[max(u, v)] = min(u, v)
    return {d: (sorted(map(len, s)), None if d is None else root(d)) for d, s in sets.items()}


def near_copies(seed):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(400)}"
    passage = [word() for _ in range(40)]
    rows, d = [], 100
    for _ in range(12):
        base = [word() for _ in range(rng.randrange(3, 160))]
        for _ in range(rng.randrange(1, 7)):
            copy = list(base)
            for _ in range(rng.randrange(0, 5)):
                copy[rng.randrange(len(copy))] = word()
            if rng.random() < 0.3:
                copy += passage
            rows.append((d, " ".join(copy)))
            d += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("n", "percent", "docs"), [(4, 85, 4096), (3, 60, 5)])
def test_similar_groups_match_brute_force(spark, monkeypatch, n, percent, docs):
    monkeypatch.setattr(jaccard, "TREE_DOCS", docs)  # several trees in a cluster
    rows = near_copies(n) + [r for r in ODD if r[1] is not LONG] + [(14, "k l m n o p q r"), (14, "other words of row fourteen")]
    # an id whose one row is a copy, and whose other row alone is like a third document
    long = " ".join(f"y{k}" for k in range(60))
    rows += [(9001, "k l m n o p q r"), (9001, long), (9002, f"{long} and")]
    got = defaultdict(lambda: [[], set()])
    for r in jaccard.similar_groups(frame(spark, rows), n, percent).collect():
        got[r.doc_id][0].append(r.n_shingles)
        got[r.doc_id][1].add(r.component_id)
    assert {d: (sorted(v[0]), *v[1]) for d, v in got.items()} == brute_groups(rows, n, percent)


def test_trees_find_what_pairs_find():
    rng = np.random.default_rng(3)
    base = [np.unique(rng.integers(0, 1 << 63, rng.integers(1, 80)).astype(np.uint64)) for _ in range(15)]
    sets = [np.unique(np.r_[b[rng.random(len(b)) < 0.93], b[:1]]) for b in base for _ in range(9)]
    found = jaccard.Links(len(sets))
    for a, b in jaccard.link_sets(list(range(len(sets))), sets, 70):
        assert jaccard.similar(sets[a], sets[b], 70)
        found.parent[max(found.root(a), found.root(b))] = min(found.root(a), found.root(b))
    want = jaccard.Links(len(sets))
    for a in range(len(sets)):
        for b in range(a):
            want.check(b, a, sets[b], sets[a], 70)
    assert found.labels().tolist() == want.labels().tolist()
    half = len(sets) // 2
    across = jaccard.link_sets(list(range(half)), sets[:half], 70, (list(range(half, len(sets))), sets[half:]))
    assert {a < half <= b for a, b in across} <= {True}


def test_passages_are_found(spark):
    rng = random.Random(8)
    fresh = iter(range(10**6))
    words = lambda n: [f"u{next(fresh)}" for _ in range(n)]
    shared, fuzzy = words(60), words(90)
    docs = {k: words(80) for k in range(8)}
    for k in (1, 3, 5):
        docs[k][20:20] = shared
    for k in (2, 6):
        copy = list(fuzzy)
        for at in rng.sample(range(90), 5):
            copy[at] = words(1)[0]
        docs[k][30:30] = copy
    docs[7][0:0] = shared[:30]  # too short to count
    rows = [(k, " ".join(w).upper()) for k, w in docs.items()] + [(20, None), (21, ""), (None, " ".join(docs[1])), (4, "x")]
    found = substring.repeated_passages(frame(spark, rows)).collect()
    spans = defaultdict(set)
    for r in found:
        spans[r.doc_id] |= set(range(r.start, r.stop))
        assert r.other_id != r.doc_id and r.passage_stop - r.passage_start >= 50
    assert set(spans) == {1, 2, 3, 5, 6}
    assert all(set(range(22, 78)) <= spans[k] for k in (1, 3, 5))
    assert all(len(spans[k] & set(range(30, 120))) >= 70 for k in (2, 6))


def test_passages_agree_and_count_their_edits(spark):
    rng, fresh = random.Random(9), iter(range(10**6))
    words = lambda n: [f"v{next(fresh)}" for _ in range(n)]
    # 1, 2: runs of 16 equal words with 10 others between them; in 3, 4 they stand beside 100 equal words with 4 replaced
    poor = [words(16) for _ in range(9)]
    equal = words(100)
    docs = {k: words(40) + [w for run in poor for w in (*run, *words(10))] + words(40) for k in (1, 2)}
    poor = [words(16) for _ in range(9)]
    changed = list(equal)
    for at in (26, 50, 51, 75):
        changed[at] = words(1)[0]
    for k, part in ((3, equal), (4, changed)):
        docs[k] = words(30) + part + [w for run in poor for w in (*words(10), *run)] + words(40)
    docs[5] = words(50)
    found = substring.repeated_passages(frame(spark, [(k, " ".join(w)) for k, w in docs.items()])).collect()
    assert {(r.doc_id, r.other_id) for r in found} == {(3, 4), (4, 3)}
    for r in found:
        a, b = docs[r.doc_id][r.start : r.stop], docs[r.other_id][r.other_start : r.other_stop]
        assert r.edits == substring.distance(a, b) <= substring.EDITS * len(a)
        assert r.start <= 30 and r.stop >= 130
    # parts against every choice
    for _ in range(300):
        between, x, y = [], 0, 0
        for _ in range(rng.randrange(6)):
            x, y, n = x + rng.randrange(1, 20), y + rng.randrange(1, 20), rng.randrange(1, 15)
            between.append([x, x + n, y, y + n, rng.randrange(1, n + 1)])
            x, y = x + n, y + n
        starts, stops = [0, *(h[1] for h in between)], [*(h[0] for h in between), x + 9]
        ranges = [(i, j) for i in range(len(starts)) for j in range(i, len(starts))]
        agree = [stops[j] - starts[i] for i, j in ranges if sum(h[4] for h in between[i:j]) <= 0.2 * (stops[j] - starts[i]) + 1e-9]
        parts = substring.agreeing((0, x + 9, 0, y + 9), between, 6)
        assert max(b - a for a, b, *_ in parts) == max(agree)
        assert all(e <= 0.2 * (b - a) + 1e-9 for a, b, _, _, e in parts)


def test_chains_are_the_best():
    parts = [(0, 0, 20), (30, 31, 20), (33, 400, 8), (60, 60, 30)]
    assert substring.chains(parts)[0] == [(0, 0, 20), (30, 31, 20), (60, 60, 30)]
    assert substring.chains([(0, 0, 10), (500, 500, 10)]) and len(substring.chains([(0, 0, 10), (500, 500, 10)])) == 2
    assert substring.distance(list("kitten"), list("sitting")) == 3


# --- quality -----------------------------------------------------------------------------------


def test_quality_on_held_out_labels(spark):
    folder = SF.replace("0.001", "0.01")
    rows = {r.doc_id: r for r in QUERIES["op9_quality"](spark, folder).collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    held = [x for x in labels if zlib.crc32(str(x.doc_id).encode()) % 4 == 2]
    assert all(rows[x.doc_id].held_out for x in held)
    assert sum(rows[x.doc_id].predicted == x.quality for x in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows.values())


def test_trees_walk_like_plain_ones():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, len(quality._NAMES)))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    trees = quality.fit(x, y, trees=20, depth=3)
    for row, score in zip(x[:50], trees.score(x[:50]), strict=True):
        total = trees.base
        for f, limit, value in zip(trees.feature, trees.limit, trees.value, strict=True):
            k = 0
            while k < len(f):
                k = 2 * k + 1 + int(row[f[k]] > limit[k])
            total += value[k - len(f)]
        assert score == pytest.approx(1 / (1 + np.exp(-total)))
    assert ((trees.score(x) > 0.5) == y).mean() > 0.9
    assert quality.fit(x[:0], y[:0]).score(x[:3]).tolist() == [0.5] * 3
    assert quality.fit(x, np.ones(400)).score(x[:1])[0] > 0.99


def test_quality_of_odd_rows(spark):
    docs = frame(spark, ODD)
    none = spark.createDataFrame([(1, None, 0), (None, 1, 0), (2, 1, None)], "doc_id bigint, quality int, toxic int")
    scored = quality.score(docs, quality.train(docs, none))
    rows = scored.collect()
    assert len(rows) == len(ODD) and set(docs.columns) <= set(scored.columns)
    assert all(np.isfinite(r.score) for r in rows)


# --- nothing at all, and everything in turn --------------------------------------------------------


def test_empty_tables(spark):
    docs = frame(spark, [])
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert urls.judge(pages, RULES).count() == 0
    assert exact.find_copies(docs).count() == 0
    assert lines.drop_repeated_lines(docs).count() == 0
    assert packing.pack(docs, tokenizer_path(), {"a": 1}, 1).count() == 0
    assert token_counts.limits(token_counts.length_histogram(docs, tokenizer_path())).count() == 0
    assert warc.read_records(warc.write_archives(pages)).count() == 0
    assert decontaminate.find_leaks(docs, bench).count() == 0
    assert jaccard.similar_groups(docs).count() == 0
    assert substring.repeated_passages(docs).count() == 0
    trees = quality.train(docs, spark.createDataFrame([], "doc_id bigint, quality int, toxic int"))
    assert quality.score(docs, trees).count() == 0


def test_pipeline_keeps_all_documents_without_labels(spark, tmp_path):
    import corpus_pipeline

    docs, kinds = frame(spark, ODD), "doc_id bigint, quality int, toxic int"
    held_out = next(k for k in range(1, 12) if zlib.crc32(str(k).encode()) % 4 == 2)
    for k, labels in enumerate(([], [(1, None, 0), (None, 1, 0), (10**9, 1, 0), (held_out, 0, 0)])):
        spark.createDataFrame(labels, kinds).write.parquet(f"{tmp_path}/{k}/labels.parquet")
        with pytest.warns(UserWarning, match="no usable label"):
            kept = corpus_pipeline.good_documents(spark, docs, f"{tmp_path}/{k}")
        assert kept.columns == docs.columns
        assert sorted(kept.collect(), key=str) == sorted(docs.collect(), key=str)


def test_pipeline_matches_brute_force(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    trees = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    good = {r.doc_id: r.text for r in quality.score(docs, trees).filter("predicted = 1").collect()}
    first = {}
    for d in sorted(good):
        first.setdefault(norm(good[d]), d)
    kept = {d: good[d] for d in first.values()}
    groups = brute_groups(list(kept.items()), 5, 80)
    kept = {d: t for d, t in kept.items() if groups[d][1] == d}
    items = [decontaminate.words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {d: t for d, t in kept.items() if all(plain_distance(i, decontaminate.words(t)) > len(i) // 5 for i in items)}
    encoder = Encoder(tokenizer_path())
    got = Counter()
    for r in corpus_pipeline.run(spark, SF).collect():
        got[r.doc_id] += r.length
    assert got == {d: len(encoder.ids(t)) + 1 for d, t in kept.items()}


def test_benchmark_stays_in_the_shared_folder(spark):
    """Many blocks, one with no item: what travels with tasks names the folder and nothing of the items."""
    import pickle

    bench = spark.createDataFrame([(n, f"item number {n} has words of its own w{n} x{n} y{n}") for n in range(40)], "item_id long, text string")
    blocks = decontaminate._write_blocks(bench, 0.2, 40)
    assert blocks.count > 40 and len(pickle.dumps(blocks)) < 1000
    assert sorted(i for b in blocks for i, _ in b.items) == list(range(40))
    found = decontaminate.find_leaks(bench.withColumnRenamed("item_id", "doc_id"), bench, block_chars=40)
    assert {r.doc_id for r in found.filter("distance = 0 and doc_id = item_id").collect()} == set(range(40))
