"""URL filters, quality rules, decontamination and chat formatting."""

import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from demandops.llm import chat_format, decontamination, quality_rules, url_filter
from demandops.llm.queries import URL_RULES
from tests.llm.helpers import documents, odd_texts, prose, rows_of

URLS = ["http://a.example.org/es/x", "https://EXAMPLE.org/en/12?q=1", "http://x.com/fr/1#t", "http://x.com/de/",
        "http://notorg/es/", "http://spam.net/a/?utm_source=x&b=1", "http://www.spam.net/a?b=1#f", "nothing", "", None,
        "x://", "ftp://host?x", "http://example.org:80/es", "http://org/", "a://b://c/d", "http://spam.net/a/?utm_source=x&b=1"]


def brute_rule(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [(len(h) + len(p), h + p, a) for a, h, p in URL_RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1:] if fits else None


def test_url_filter_rules_and_listing(spark):
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(URLS)],
                                  "page_id long, url string, host string, rule string")
    listing = spark.createDataFrame([("http://spam.net/a?b=1",), (None,), ("junk",)], "u string")
    got = {r["page_id"]: r for r in url_filter.filter_urls(pages, listing, URL_RULES).collect()}
    assert len(got) == len(URLS)
    for i, u in enumerate(URLS):
        host, path, rule = brute_rule(u)
        listed = u is not None and "spam.net" in u
        assert (got[i]["host"], got[i]["path"], got[i]["listed"]) == (host, path, listed)
        assert got[i]["rule"] == (rule[0] if rule else None)
        assert got[i]["verdict"] == (rule[1] if rule else "block" if listed else "allow")
    empty = url_filter.filter_urls(pages.limit(0), listing.limit(0), URL_RULES)
    assert empty.count() == 0
    assert url_filter.filter_urls(pages, listing.limit(0), URL_RULES).filter("listed").count() == 0


def brute_statistics(text):
    text = text or ""
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    hit = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)} if len(grams) < 2000 \
        else set(range(len(w)))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit))


STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@pytest.mark.parametrize("bits", [20, 3])
def test_quality_statistics(spark, bits, monkeypatch):
    """With 3 position bits, texts of eight words or more take the exact way."""
    monkeypatch.setattr(quality_rules, "POS_BITS", bits)
    rng = random.Random(1)
    texts = [t for _, t in odd_texts()] + [prose(rng, n, 5) for n in (1, 2, 3, 4, 7, 30, 90)] + \
        ["a\nb\na\n\n \nb", "#*$ <a> | & é\u3000ü x\x0by", "q q q q q"]
    docs = documents(spark, list(enumerate(texts)))
    got = quality_rules.text_statistics(docs, ["doc_id"])
    assert rows_of(got, "doc_id", *STATS) == sorted(((i, *brute_statistics(t)) for i, t in enumerate(texts)), key=repr)


def test_binomial_tail_is_exact(spark):
    cases = [(n, k, a) for n in (1, 10, 400, 3000) for k in (0, 1, 3, 11) for a in (0.005, 0.02) if k <= n]
    for a in (0.005, 0.02):
        df = spark.createDataFrame([(n, k) for n, k, b in cases if b == a], "n long, k long")
        for r in df.select("n", "k", quality_rules.binomial_tail(F.col("k"), F.col("n"), a).alias("p")).collect():
            exact = sum(math.comb(r["n"], j) * a ** j * (1 - a) ** (r["n"] - j) for j in range(r["k"] + 1))
            assert r["p"] == pytest.approx(1.0 if r["k"] >= r["n"] * a else exact, rel=1e-9)


def test_certified_cutoffs_bound_false_rejections(spark):
    rng = random.Random(2)
    grid = {"x": [i / 10 for i in range(1, 11)]}
    rows = [("big", rng.random() ** 8) for _ in range(4000)] + [("small", 0.0)] * 20
    good = spark.createDataFrame(rows, "lang string, x double")
    got = {r["lang"]: r["cutoff"] for r in quality_rules.certified_cutoffs(good, "lang", 0.1, 0.05, grid).collect()}
    assert set(got) == {"big"}                      # 20 documents certify nothing
    lost = sum(x > got["big"] for s, x in rows if s == "big") / 4000
    assert lost < 0.1
    lower = [c for c in grid["x"] if c < got["big"]]
    assert not lower or sum(x > lower[-1] for s, x in rows if s == "big") / 4000 > 0.07


def test_quality_judge_edge_cases(spark):
    docs = documents(spark, odd_texts(), lang=None)
    labels = spark.createDataFrame([(4, 1), (None, 1), (99, 1), (5, None)], "doc_id long, quality int")
    got = quality_rules.judge(docs, labels).select("doc_id", "n_words", "base_failed", "kept").collect()
    assert len(got) == len(odd_texts())
    assert all(r["base_failed"] and not r["kept"] for r in got if r["n_words"] < 50)
    assert quality_rules.judge(docs.limit(0), labels.limit(0)).count() == 0


def words7(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", low) if w]


def brute_hits(texts, items):
    out = []
    for i, t in texts:
        w, hit, found = words7(t), set(), set()
        for item, body in items:
            b = words7(body)
            n = min(10, len(b))
            if item is None or not n:
                continue
            grams = {tuple(b[k:k + n]) for k in range(len(b) - n + 1)}
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in grams:
                    hit |= set(range(k, k + n))
                    found.add(str(item))
        out.append((i, len(w), len(hit), ",".join(sorted(found))))
    return sorted(out, key=repr)


def test_decontamination_against_brute_force(spark):
    rng = random.Random(3)
    base = [prose(rng, n, 30) for n in (40, 25, 12, 10, 9, 5, 3, 1)]
    items = list(enumerate(base)) + [(3, base[3]), (20, None), (21, "..."), (None, base[0]), (22, base[0].upper()), (23, "z9 z9 z9")]
    texts = list(odd_texts())
    for i in range(60):
        b = rng.choice(base).split()
        a = rng.randrange(len(b))
        mid = b[a:a + rng.randrange(1, 30)]
        texts.append((100 + i, " ".join(prose(rng, rng.randrange(0, 12), 30).split() + mid) + ". " + prose(rng, 8, 30)))
    texts += [(300, "z9 z9 z9 z9 z9"), (301, "b " * 40), (302, base[0] + " " + base[0])]
    docs = documents(spark, texts)
    bench = spark.createDataFrame([(i, t, "e") for i, t in items], "item_id long, text string, item string")
    got = decontamination.decontaminate(docs, bench)
    assert rows_of(got.withColumn("i", F.array_join("items", ",")), "doc_id", "n_words", "n_hit", "i") == brute_hits(texts, items)
    spans = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in got.filter("doc_id = 302").collect()}
    assert all(a < b for a, b in spans[302])
    kept = decontamination.drop_contaminated(docs, bench)
    clean = sorted((i for i, _, h, _ in brute_hits(texts, items) if not h), key=repr)
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == clean and kept.columns == docs.columns
    assert decontamination.decontaminate(docs, bench.limit(0)).filter("contaminated").count() == 0
    assert decontamination.decontaminate(docs.limit(0), bench).count() == 0


def test_chat_links_quotes_and_orders_replies(spark):
    rows = [(1, 0, "user", "Hello there\nhow are you"),
            (1, 1, "assistant", "Fine.\n> how  are YOU\nand you?"),
            (1, 2, "user", "unrelated"),
            (1, 3, "user", "Bob wrote:\n> Fine.\n>> how are you\nGood."),
            (1, 4, "user", "> nobody said this\nhm"),
            (2, 0, "user", "> Hello there\nother conversation"), (2, 1, None, None), (2, 1, None, None),
            (None, 0, "user", "> Fine.\nlost"), (3, None, "user", "no turn"), (4, 0, "user", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat_format.format_conversations(df.withColumn("depth", F.lit("x"))).collect()
    assert len(got) == len(rows)
    by = {(r["conv_id"], r["turn"]): r for r in got}
    assert by[1, 1]["reply_to"] == 0 and by[1, 1]["text"] == "Fine.\nand you?"
    assert by[1, 3]["reply_to"] == 1 and by[1, 3]["depth"] == 2 and by[1, 3]["root_turn"] == 0
    assert by[1, 3]["text"] == "Good." and by[1, 3]["n_quoted"] == 2
    assert by[1, 4]["reply_to"] is None and by[1, 4]["text"] == "hm"
    assert by[2, 0]["reply_to"] is None
    order = sorted((r for r in got if r["conv_id"] == 1), key=lambda r: r["position"])
    assert [r["turn"] for r in order] == [0, 1, 3, 2, 4]
    assert sorted(r["position"] for r in got if r["conv_id"] == 2) == [0, 1, 2]
    assert chat_format.format_conversations(df.limit(0)).count() == 0


def test_long_reply_chain_by_doubling(spark):
    rows = [(7, t, "user", f"line {t}" + (f"\n> line {t - 1}" if t else "")) for t in range(40)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["turn"]: (r["root_turn"], r["depth"], r["position"]) for r in chat_format.format_conversations(df).collect()}
    assert got == {t: (0, t, t) for t in range(40)}


def test_sha_of_items_matches_contract():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


def test_kept_columns_may_have_an_operator_s_names(spark):
    """``keep`` with names of inner columns and of results: the first come
    back as they were, the others are the result's."""
    from demandops.llm import suffix_dedup
    names = ["_block", "_possible", "_salt", "_t1", "_t2", "t1", "t2", "_sha", "_copy", "starts", "_s", "a.b"]
    results = {"url": ["host", "Listed"], "spans": ["spans", "n_hit"], "bytes": ["n_bytes", "removed"]}
    text = "one two three four five six seven eight nine ten eleven twelve " * 5
    rows = [(1, text, "http://spam.net/a"), (2, text, "http://ok.org/es"), (3, None, None)]
    plain = spark.createDataFrame(rows, "doc_id long, text string, url string")

    def given(kind):
        return plain.select("*", *[F.concat(F.lit(n), F.col("doc_id")).alias(n) for n in names + results[kind]])
    listing = spark.createDataFrame([("http://spam.net/a",)], "u string")
    bench = spark.createDataFrame([("i", text[:60])], "item_id string, text string")
    runs = {"url": (lambda d, k: url_filter.filter_urls(d, listing, URL_RULES, keep=k)),
            "spans": (lambda d, k: decontamination.decontaminate(d, bench, keep=k)),
            "bytes": (lambda d, k: suffix_dedup.remove_repeats(d, keep=k))}
    for kind, run in runs.items():
        want = {r["doc_id"]: r.asDict() for r in run(plain, ["doc_id"]).collect()}
        out = run(given(kind), ["doc_id", *names, *results[kind]])
        assert len({c.lower() for c in out.columns}) == len(out.columns)
        for r in out.collect():
            r = r.asDict()
            assert {n: r.pop(n) for n in names} == {n: f"{n}{r['doc_id']}" for n in names}, kind
            assert r == want[r["doc_id"]], kind
