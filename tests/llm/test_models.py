"""The label model with tied voters, the drawn sample, and URL rules in any number, against plain versions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import toxicity, urlfilter

V = toxicity.VOTERS


def corpus(seed, n=400, known=80):
    """Votes of n rows in which voter 1 repeats voter 0 and voter 2 mostly does; the first rows are labelled."""
    rng = np.random.default_rng(seed)
    truth = rng.random(n) < 0.3
    votes = np.array([[rng.random() < (0.7 if t else 0.15) for _ in range(V)] for t in truth])
    votes[:, 1] = votes[:, 0]
    votes[:, 2] = np.where(rng.random(n) < 0.9, votes[:, 0], votes[:, 2])
    patterns = np.array([sum(1 << k for k, v in enumerate(row) if v) for row in votes])
    kinds, counts = np.unique(patterns, return_counts=True)
    toxic = np.array([sum(1 for k in range(known) if truth[k] and patterns[k] == p) for p in kinds])
    clean = np.array([sum(1 for k in range(known) if not truth[k] and patterns[k] == p) for p in kinds])
    return truth, patterns, kinds, counts, toxic, clean


def test_tied_voters_match_a_plain_version():
    truth, patterns, kinds, counts, toxic, clean = corpus(3)
    start = toxicity.LabelModel(kinds, counts, toxic, clean, rounds=5, tied_rounds=0)
    model = toxicity.LabelModel(kinds, counts, toxic, clean, rounds=5, tied_rounds=1)
    rows = [(p, None) for p in patterns] + [(patterns[k], int(truth[k])) for k in range(80)]
    mass = []
    for p, y in rows:
        q = float(start.posterior(np.array([p]))[0]) if y is None else y
        mass.append((1 - q, q))
    bit = lambda p, k: int(p) >> k & 1
    total = [sum(m[y] for m in mass) for y in (0, 1)]

    def count(y, *held):
        return sum(m[y] for m, (p, _) in zip(mass, rows) if all(bit(p, k) == v for k, v in held))

    def information(i, j):
        sum_ = 0.0
        for y in (0, 1):
            for a in (0, 1):
                for b in (0, 1):
                    n = count(y, (i, a), (j, b))
                    if n > 1e-9:
                        sum_ += n * math.log(n * total[y] / (count(y, (i, a)) * count(y, (j, b))))
        return sum_

    edges = sorted(((information(i, j), i, j) for i in range(V) for j in range(i)), reverse=True)
    group, tree = list(range(V)), set()
    for _, i, j in edges:
        if group[i] != group[j]:
            tree.add(frozenset((i, j)))
            group = [group[i] if g == group[j] else g for g in group]
    own_tree = {frozenset((k, int(model.parents[k]))) for k in range(1, V)}
    weigh = lambda t: sum(information(*sorted(e)) for e in t)  # ties between voters 0 and 1, which are equal, may fall either way
    assert len(own_tree) == V - 1 and model.parents[0] == -1 and frozenset((0, 1)) in own_tree and weigh(own_tree) == pytest.approx(weigh(tree))
    for y in (0, 1):
        for k in range(1, V):
            own = (count(y, (k, 1)) + 1) / (total[y] + 2)
            for v in (0, 1):
                want = (count(y, (k, 1), (int(model.parents[k]), v)) + 2 * own) / (count(y, (int(model.parents[k]), v)) + 2)
                assert model.given[y, k, v] == pytest.approx(want, abs=1e-9)


def test_a_repeated_voter_adds_nothing():
    _, patterns, kinds, counts, toxic, clean = corpus(4)
    tied = toxicity.LabelModel(kinds, counts, toxic, clean)
    apart = toxicity.LabelModel(kinds, counts, toxic, clean, tied_rounds=0)
    silent = np.array([p for p in kinds if not p & 7])
    assert len(silent)
    gain = lambda m: m.posterior(silent | 3)  # both copies vote
    odds = lambda q: np.log(q / (1 - q))
    one = math.log(tied.rate[1, 0] / tied.rate[0, 0]) - math.log((1 - tied.rate[1, 0]) / (1 - tied.rate[0, 0]))
    assert np.median(odds(gain(tied)) - odds(tied.posterior(silent))) < 1.5 * one
    assert np.median(odds(gain(apart)) - odds(apart.posterior(silent))) > 1.5 * one


def test_what_is_drawn_does_not_hang_on_the_layout(spark):
    rows = spark.range(3000).select((F.col("id") % 3 - 1).cast("int").alias("label"), F.when(F.col("id") < 1500, 7).otherwise(F.col("id")).cast("int").alias("votes"), F.array((F.col("id") % 2).cast("int")).alias("hits"))
    share = F.when(F.col("label") < 0, 0.1).otherwise(2.0)
    got = [sorted(map(tuple, toxicity.copies_drawn(rows.repartition(n), share).collect())) for n in (1, 5)]
    assert got[0] == got[1]
    times = {y: sum(r[3] for r in got[0] if r[0] == y) for y in (-1, 0, 1)}
    assert times[0] == times[1] == 1000 and 70 < times[-1] < 130
    assert sum(r[3] for r in got[0] if r[0] == -1 and r[1] == 7) in range(48, 53)  # 500 copies in two kinds, to the next whole number


def test_scores_do_not_hang_on_the_layout(spark):
    docs = spark.range(300).select("id", F.concat_ws(" ", F.lit("plain"), F.expr("CASE WHEN id % 4 = 0 THEN 'gnarfle idiot' ELSE concat('word', id % 9) END")).alias("text")).withColumnRenamed("id", "doc_id")
    labels = docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    got = [sorted(map(tuple, toxicity.toxicity(docs.repartition(n), labels, sample=20, rows=50).collect())) for n in (1, 4)]
    assert got[0] == got[1] and all(r[3] == (r[0] % 4 == 0) for r in got[0])


def test_lexicons_are_bounded(spark):
    rows = spark.createDataFrame([(k % 2, ("bad " + "y" * 80 if k % 2 else "good") + f" w{k % 7}") for k in range(400)], "toxic int, text string")
    full = toxicity.mine(rows, (200, 200))
    assert {e for e, _ in full} == {b"bad", b"yyyy*", b"yyyyy*", b"yyyyyy*", b"*yyyy"} and toxicity.mine(rows, (200, 200), 2) == full[:2]


def test_urls_by_array_and_by_join_match_brute_force(spark):
    rng = np.random.default_rng(8)
    pick = lambda *x: x[rng.integers(0, len(x))]
    hosts = lambda: ".".join(pick("a", "b", "c", "poker", "é") for _ in range(rng.integers(1, 4)))
    paths = lambda: pick("", "/", "/x", "/x/", "/é", "/x/y?q=/x")
    rules = [(hosts(), pick("", "/", "/x", "/x/", "/é"), pick("block", "allow")) for _ in range(60)] + [("*poker", "", "allow"), ("?c", "", "allow")]
    urls = [f"http://{hosts()}{paths()}" for _ in range(400)] + ["http://B.com/"] * 800 + [None, "", "no", "http://", "http://*poker/", "http://poker", "http://a." + "x" * 100_000 + "/"]
    own = {}
    for h, p, action in rules:
        own[h + p] = (h, p, action)

    def brute(url):
        _, mark, rest = (url or "").partition("://")
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest)) if mark else 0
        host, tail = (rest[:cut].lower(), rest[cut:]) if mark else ("", "")
        path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
        fit = [k for k, (h, p, _) in own.items() if (host == h or host.endswith("." + h)) and path.startswith(p) and "?" not in h]
        best = max(fit, key=lambda k: (len(k.encode()), k.encode()), default=None)
        named = "poker" in host.replace("-", ".").split(".")
        return host, path, best, own[best][2] if best else "block" if named else "allow"

    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").repartition(4)
    for shipped in (urlfilter.SHIPPED, 0):
        got = {r["page_id"]: tuple(r)[1:] for r in urlfilter.judge(pages, rules, ["poker"], shipped).collect()}
        assert got == {k: brute(u) for k, u in enumerate(urls)}
    assert urlfilter.judge(pages.limit(0), rules, [], 0).count() == 0 and urlfilter.judge(pages, [], [], -1).where("rule IS NOT NULL OR verdict <> 'allow'").count() == 0


def test_a_million_rules_sorted_by_spark(spark):
    rules = spark.range(1_000_000).select(F.concat(F.lit("h"), "id", F.lit(".example")).alias("host"), F.expr("CASE WHEN id % 2 = 0 THEN '/' ELSE '/p/' END").alias("path"), F.expr("CASE WHEN id % 5 = 0 THEN 'allow' ELSE 'block' END").alias("action"))
    rules = rules.unionByName(spark.createDataFrame([("h5.example", "/p/", "block"), (None, "/", "block"), ("x", None, "block"), ("x", "/", None)], "host string, path string, action string"))
    pages = spark.range(2000).select("id", F.concat(F.lit("http://www.H"), F.col("id") * 1000 + F.col("id") % 7, F.lit(".example/p/1")).alias("url"), F.lit("h").alias("host")).withColumnRenamed("id", "page_id")
    n = lambda r: r["page_id"] * 1000 + r["page_id"] % 7
    for shipped in (urlfilter.SHIPPED, 1 << 20):
        got = urlfilter.judge(pages, rules, [], shipped).collect()
        assert len(got) == 2000
        for r in got:
            known = n(r) < 1_000_000
            assert r["rule"] == (f"h{n(r)}.example/{'p/' if n(r) % 2 else ''}" if known else None)
            assert r["verdict"] == ("block" if known and (n(r) % 5 or n(r) == 5) else "allow")
