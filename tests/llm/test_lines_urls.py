import hashlib
import random

from helpers import awkward, documents, lower

from barforge.llm import op2_lines, op10_urls
from pyspark.sql import functions as F

BLANK = " \t\n\x0b\x0c\r"


def brute_lines(rows):
    keys = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            k = lower(line.strip(BLANK))
            if len(k) >= 10:
                keys.setdefault(k, set()).add(2**63 - 1 if doc is None else doc)
    out = []
    for doc, text in rows:
        lines, own = (text or "").split("\n"), 2**63 - 1 if doc is None else doc
        kept = [x for x in lines if len(d := keys.get(lower(x.strip(BLANK)), ())) < 2 or min(d) == own]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def order(rows):
    return sorted(rows, key=repr)


def test_line_dedup_against_brute_force(spark):
    rows = awkward(random.Random(1))
    out = op2_lines.dedup_lines(documents(spark, rows))
    got = [(r.doc_id, r.n_lines, r.n_dropped, r.text) for r in out.collect()]
    assert order(got) == order(brute_lines(rows))
    assert sum(r[2] for r in got) > 10 and {"line", "c0", "size"} <= set(out.columns)


def test_line_dedup_stage_keeps_the_columns(spark):
    docs = documents(spark, awkward(random.Random(1)))
    out = op2_lines.without_repeated_lines(docs)
    assert out.dtypes == docs.dtypes and out.count() == docs.count()
    assert out.where(F.col("n_chars") != F.length("text")).isEmpty()
    assert op2_lines.without_repeated_lines(docs.limit(0)).count() == 0


def test_line_threshold(spark):
    docs = documents(spark, [(1, "the same line"), (2, "the same line"), (3, "the same line\nother line one"), (4, "Other LINE one")])
    got = {r.doc_id: r.text for r in op2_lines.dedup_lines(docs, min_docs=3).collect()}
    assert got == {1: "the same line", 2: "", 3: "other line one", 4: "Other LINE one"}


def brute_url(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = rest
        for c in "/?#":
            host = host.split(c)[0]
        path = rest[len(host):].split("?")[0].split("#")[0]
        host = lower(host)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


URLS = ["http://net", "http://NET/", "https://a.b.example.net/en/x?y#z", "http://example.net/en", "ftp://xexample.net/en/", None, "", "net/",
        "http://", "x://example.com/de/?", "http://q.example.com/de/1", "http://org/fr/", "http://a.org/fr/b/c", "http://a.org#/fr/",
        "http://.net/", "http://a..net/", "http://net-x/", "http://x.net-x.org/fr/", "a://b://net/", "http://u\nv.net/\n/x", "http://org?/fr/",
        "http://\u00c9T\u00c9.Net/", "http://example.net:80/en/", "http://" + "long." * 3000 + "net/" + "p/" * 5000]


def test_urls_against_brute_force(spark):
    rng = random.Random(3)
    labels, rules = ["net", "org", "a", "b-c", "b"], list(op10_urls.RULES)
    seen = {(r[0], r[1]) for r in rules}
    for _ in range(60):
        h = ".".join(rng.choice(labels) for _ in range(rng.randrange(1, 4)))
        p = "/" + "".join(rng.choice(["a/", "b", "c"]) for _ in range(rng.randrange(0, 3)))
        if (h, p) not in seen:
            seen.add((h, p))
            rules.append((h, p, rng.choice(["allow", "block"])))
    urls = URLS + ["http://" + ".".join(rng.choice(labels) for _ in range(rng.randrange(1, 5))) + "/" + "".join(
        rng.choice(["a/", "b", "c"]) for _ in range(rng.randrange(0, 4))) for _ in range(600)]
    urls += ["http://hot.example.net/en/1"] * 300
    rows = [(None if i == 3 else i // 2, u, "other", "h") for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    table = spark.createDataFrame(rules + [(None, "/", "block"), ("net", None, "block")], "host string, path string, verdict string")
    got = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in op10_urls.filter_urls(pages, table).collect()]
    assert order(got) == order((r[0], *brute_url(r[1], rules)) for r in rows)


def test_urls_without_rows_or_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert [tuple(r) for r in op10_urls.filter_urls(pages, none).collect()] == [(1, "a.net", "/", None, "allow")]
    rules = spark.createDataFrame(op10_urls.RULES, "host string, path string, verdict string")
    assert op10_urls.filter_urls(pages.limit(0), rules).count() == 0


def test_digest_is_of_the_kept_text(spark, tmp_path):
    documents(spark, [(1, "alpha beta gamma"), (2, "Alpha beta gamma\nz")]).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.kept_sha256 for r in op2_lines.op2_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {1: hashlib.sha256(b"alpha beta gamma").hexdigest(), 2: hashlib.sha256(b"z").hexdigest()}
