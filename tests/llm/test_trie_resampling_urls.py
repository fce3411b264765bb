"""The conversation trie, resampling and URL filters, against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import Row

from lakequery.llm import conversation_trie, resampling, url_filters

TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turn_digest(role, text):
    data = f"{len(role.encode())}:{role}{text}".encode()
    return hashlib.sha256(data).digest()[:16]


def trie_by_hand(rows):
    """rows: conv_id, turn, role, text."""
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append((turn is not None, turn or 0, role or "", turn_digest(role or "", text or ""), text or ""))
    own = {c: [(r, t) for _, _, r, _, t in sorted(turns)] for c, turns in own.items()}
    members, ends = defaultdict(set), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        lender = c - int(math.fmod(c, 5))
        rebuilt = tuple(own.get(lender, [])[:h] + turns[h:])
        for d in range(len(rebuilt) + 1):
            members[rebuilt[:d]].add(c)
        ends[rebuilt].append(c)
    children = Counter(path[:-1] for path in members if path)
    out = []
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        out.append((
            min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), children[path],
            sum(children[p] == 0 for p in below),
            sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p),
            hashlib.sha256(",".join(map(str, sorted(ends[path]))).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


CONVERSATIONS = "conv_id long, turn int, role string, text string"


def random_conversations(seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample([*range(-12, 60), 10**12, 10**12 + 3], 45):
        for k in range(rng.randint(1, 14)):
            turn = None if rng.random() < 0.1 else rng.randint(0, 6) if rng.random() < 0.2 else k
            rows.append((c, turn, rng.choice(["u", "a", None, ""]), rng.choice(["é", "yes", "no", None, "", "u"])))
    rows += rng.choices(rows, k=20) + [(None, 1, "u", "lost"), (None, None, None, None)]
    rng.shuffle(rows)
    return rows


def trie_rows(df):
    return sorted((tuple(row[c] for c in TRIE) for row in df.collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_trie(spark, seed):
    rows = random_conversations(seed)
    df = spark.createDataFrame(rows, CONVERSATIONS).repartition(3).selectExpr("*", "1 AS depth", "2 AS digest", "3 AS owner")
    got = conversation_trie.prefix_trie(spark, df)
    assert got.dtypes == [(c, "bigint") for c in TRIE[:-1]] + [("ends_sha256", "string")]
    assert trie_rows(got) == trie_by_hand(rows)


def test_trie_with_a_sketch_that_proves_nothing(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "LEAST_WIDTH", 4)
    monkeypatch.setattr(conversation_trie, "MOST_WIDTH", 4)
    rows = random_conversations(9)
    assert trie_rows(conversation_trie.prefix_trie(spark, spark.createDataFrame(rows, CONVERSATIONS))) == trie_by_hand(rows)


def test_trie_of_conversations_longer_than_a_partition(spark, monkeypatch):
    """Sorted turns of one conversation fill many partitions; two others end in the middle of it and many share its beginning."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    monkeypatch.setattr(conversation_trie, "CHUNK_IDS", 3)
    try:
        rows = [(0, k, "u", f"t{k}" * (k % 3)) for k in range(300)]
        rows += [(7, k, "u", f"t{k}" * (k % 3)) for k in range(150)]
        rows += [(c, k, "u", f"t{k}" * (k % 3)) for c in range(20, 80, 5) for k in range(9)]
        rows += [(4, 0, "u", "only one")]
        assert trie_rows(conversation_trie.prefix_trie(spark, spark.createDataFrame(rows, CONVERSATIONS))) == trie_by_hand(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_trie_of_nothing(spark):
    empty = spark.createDataFrame([], CONVERSATIONS)
    assert conversation_trie.prefix_trie(spark, empty).collect() == []


# -- resampling ---------------------------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def resampled_by_hand(docs, target, max_words, min_words, percent):
    def words(text):
        return WORD.findall((text or "").translate(UPPER))

    def runs(text):
        own = words(text)
        return [" ".join(own[k : k + n]) for n in range(1, max_words + 1) for k in range(len(own) - n + 1)]

    def bucket(run):
        return zlib.crc32(run.encode()) % 10000

    corpus = Counter(bucket(r) for _, text in docs for r in runs(text))
    aims = Counter(bucket(r) for text in target for r in runs(text))
    s_all, t_all = sum(corpus.values()), sum(aims.values())

    def gain(b):
        return math.floor(1000 * math.log((aims[b] + 1) * (s_all + 10000) / ((corpus[b] + 1) * (t_all + 10000))))

    rows = []
    for doc_id, text in docs:
        weight = sum(gain(bucket(r)) for r in runs(text))
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(runs(text)), weight, score, len(words(text)) >= min_words])
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = len(able) * percent // 100
    place = {id(r): k + 1 for k, r in enumerate(able[:drawn])}
    return sorted(((*r[:4], place.get(id(r))) for r in rows), key=str)


@pytest.mark.parametrize("max_words", [1, 2, 3])
def test_resampling(spark, monkeypatch, max_words):
    monkeypatch.setattr(resampling, "SLICE_BYTES", 64)
    rng = random.Random(max_words)
    parts = ["The", "the", "cat-sat", "x1", "é", "ÉCOLE", "中文", "\n", "a\x00b", "_", "'", "\x85", "\xa0", "w" * 90]
    docs = [(k, " ".join(rng.choices(parts, k=rng.randint(0, 40)))) for k in range(120)]
    docs += [(200, None), (201, ""), (202, " \t-"), (None, "the cat " * 20), (203, "long " * 400), (204, "y" * 500)]
    target = ["the cat sat", None, "école école 中文", "x1 " * 30]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "0 AS weight", "'' AS bag")
    got = resampling.resample(
        spark, df, spark.createDataFrame([(t,) for t in target], "text string"), max_words=max_words, min_words=5, percent=30
    )
    assert got.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    assert sorted(map(tuple, got.collect()), key=str) == resampled_by_hand(docs, target, max_words, 5, 30)


def test_words_cut_anywhere_are_the_same():
    text = ("ab  cd " + "e" * 70 + " f-g " * 9 + "é" * 40).encode()
    whole = [w.encode() for w in WORD.findall(text.decode())]
    for bound in (1, 2, 5, 16, 64, 1000):
        assert [w for part in resampling.parts_of(text, bound) for w in part] == whole


def test_frequent_runs_change_nothing_but_the_time():
    words = "a b c a b d é".encode().split()
    plain, head = resampling.Hasher({}, 3, 1000), {}
    for run in (b"a", b"b", b"a b", b"b c"):
        head[run] = zlib.crc32(run)
    assert plain.bag(words, []).tolist() == resampling.Hasher(head, 3, 1000).bag(words, []).tolist()


def test_repeated_ids_and_empty_tables(spark):
    docs = [(1, "same words here"), (1, "same words here"), (1, "other words")]
    df, none = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([], "doc_id long, text string")
    got = resampling.resample(spark, df, none, min_words=1, percent=67)
    assert sorted(row["rank"] or 0 for row in got.collect()) == [0, 1, 2]
    assert sorted(map(tuple, got.drop("rank").collect())) == sorted(
        row[:4] for row in resampled_by_hand(docs, [], 1, 1, 67)
    )
    assert resampling.resample(spark, none, df).collect() == []


# -- url filters --------------------------------------------------------------------------------------


def split_by_hand(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(UPPER), re.match(r"[^?#]*", rest[len(host) :])[0]


def judged_by_hand(url, hosts, patterns, otherwise):
    host, path = split_by_hand(url)
    fits = [
        (len(h + p), len(h), action, h + p)
        for action, h, p in hosts
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    if fits:
        best = max(fits)
        return host, path, best[3], best[2], None
    seen, found = (host + path).translate(UPPER), []
    for action, pattern in patterns:
        text = pattern.translate(UPPER)
        front = r"^(?:[^/]*\.)?" if text.startswith("||") else ""
        body = "".join({"*": ".*", "^": r"(?:[^a-z0-9_.%-]|$)"}.get(c, re.escape(c)) for c in text.removeprefix("||"))
        if re.search(front + body, seen, re.DOTALL):
            found.append((len(text), action, text))
    return (host, path, None, *(max(found)[1:] if found else (otherwise, None)))


def test_urls(spark):
    rng = random.Random(5)
    hosts = ["org", "example.org", "WWW.Example.ORG", "notexample.org", "a.ads-track.net", "com", "x.com:80", "u@org", "", "é.com"]
    paths = ["", "/", "/es/", "/ES/", "/en/1", "/en/15/x", "/fr/", "/login", "/login/", "/loginx", "/ads/archive/x", "/ads/", "/a\nb/cart",
             "/calendar/2024/print", "/é/search", "/en", "/deep/" * 300]
    urls = [f"{rng.choice(['http', 'HTTPS', ''])}://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '?q=/es/', '#x', '?a://b'])}" for _ in range(500)]
    urls += [None, "", "no scheme/es/", "://", "http:/org/", "a://b://c.org/"]
    pages = spark.createDataFrame([Row(page_id=None if k % 50 == 0 else k, url=u, host="clash", path=1, rule=2) for k, u in enumerate(urls)],
                                  "page_id long, url string, host string, path int, rule int")
    rules = [*url_filters.HOST_RULES, ("block", "com", ""), ("block", "EXAMPLE.org", "/ES/"), ("allow", "org", "/en/1")]
    patterns = [*url_filters.PATTERN_RULES, ("block", "ogin"), ("allow", "||é.com^"), ("block", "a+b(c"), ("block", "*/deep/*/deep/")]
    got = url_filters.judge_urls(
        spark, pages, url_filters.host_rule_table(spark, rules), url_filters.pattern_rule_table(spark, patterns)
    )
    low = [(a, h.translate(UPPER), p) for a, h, p in rules]
    want = Counter((None if k % 50 == 0 else k, *judged_by_hand(u, low, patterns, "allow")) for k, u in enumerate(urls))
    assert Counter(tuple(r[c] for c in ("page_id", "host", "path", "rule", "verdict", "pattern")) for r in got.collect()) == want


def test_rules_are_filed_under_their_rarest_whole_word(spark):
    urls = ["http://a.example.org/es/1", "http://b.example.org/en/1", "http://c.example.org/es/2", "http://d.com/fr/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    seen = url_filters.addresses_of(pages).selectExpr("host", "path", "concat(host, path) AS address")
    words = seen.select("host", "path", url_filters.F.explode(url_filters.words_of(url_filters.F.col("address"))).alias("word"))
    rules = url_filters.compiled(
        url_filters.host_rule_table(spark, [("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "org", "/")]),
        url_filters.pattern_rule_table(spark, [("block", "ogin"), ("block", "/a*b/")]),
    )
    filed = {row["rule"] or row["pattern"]: row["word"] for row in url_filters.index_of(rules, words).collect()}
    assert filed == {"example.org/es/": "es", "example.org/en/1": "en", "org/": "org", "ogin": "", "/a*b/": ""}


def test_url_filter_is_native_and_takes_no_rules_or_pages(spark, small):
    none = spark.createDataFrame([], "page_id long, url string")
    assert url_filters.judge_urls(spark, none).collect() == []
    page = spark.sql("SELECT 1 AS page_id, 'http://a.org/' AS url")
    empty = url_filters.judge_urls(
        spark, page, url_filters.host_rule_table(spark, []), url_filters.pattern_rule_table(spark, []), "block"
    )
    assert [tuple(r) for r in empty.collect()] == [(1, "a.org", "/", None, "block", None)]
    plan = url_filters.judge_urls(spark, spark.read.parquet(f"{small}/pages.parquet"))._jdf.queryExecution().executedPlan().toString()
    for python in ("MapInArrow", "MapInPandas", "EvalPython", "ExistingRDD", "CartesianProduct", "NestedLoopJoin"):
        assert python not in plan
