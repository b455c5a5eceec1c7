"""Merkle manifest, token counts, point-in-time features."""

import hashlib
import itertools
import random
import zlib
from collections import defaultdict
from datetime import datetime, timedelta

import duckdb
import pytest

from ledgerline.llm import merkle, pointintime, tokencounts, transducer
from ledgerline.llm.tokens import public_path

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, tree string, at int, leaf string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_audit(rows):
    """rows: doc_id, source, lang, n_chars, text."""

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([H(*levels[-1][k : k + 16]) for k in range(0, len(levels[-1]), 16)])
        return levels

    groups = defaultdict(list)
    for r in rows:
        groups[b"" if r[1] is None else b"=" + r[1].encode()].append((r[0] is not None, r[0] or 0, plain_leaf(r), r))
    trees = {k: tree([leaf for *_, leaf, _ in sorted(v, key=lambda x: x[:3])]) for k, v in groups.items()}
    names = sorted(trees)
    upper = tree([trees[k][-1][0] for k in names]) if names else []
    out = []
    for k in names:
        for at, (_, _, leaf, r) in enumerate(sorted(groups[k], key=lambda x: x[:3])):
            node, proof = leaf, []
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                node = plain_leaf((*r[:4], r[4].translate({c: c + 32 for c in range(65, 91)})))
            for levels, place in ((trees[k], at), (upper, names.index(k))):
                for nodes in levels[:-1]:
                    run = nodes[place // 16 * 16 :][:16]
                    slot = place % 16
                    proof += run[:slot] + run[slot + 1 :]
                    node = H(*run[:slot], node, *run[slot + 1 :])
                    place //= 16
            out.append((r[0], leaf, trees[k][-1][0], upper[-1][0], H(*proof), node, node == upper[-1][0]))
    return out


def audited(spark, rows):
    df = spark.createDataFrame([(i, t, lang, s, n, "clash", 1, "clash") for i, s, lang, n, t in rows], DOCS)
    return sorted((tuple(r) for r in merkle.audit(df).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=repr)


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 1, None: 1}, {"a": 16, "b": 17, None: 2}, {"a": 300, "": 1} | {f"s{k}": 1 for k in range(20)}])
def test_manifest_against_brute_force(spark, sizes):
    ids = itertools.count(-2)
    rows = [(next(ids), s, None if k % 3 else "en", k, f"Text {k} É" * (k % 5)) for s, n in sizes.items() for k in range(n)]
    assert audited(spark, rows) == sorted(plain_audit(rows), key=repr)


def test_manifest_of_odd_rows(spark):
    rows = [(None, None, None, None, None), (None, "a", None, None, "x"), (5, "a", "en", 3, ""), (5, "a", "en", 3, ""), (5, "a", "de", 3, "A" * 200_000), (7, "a:b", "-", 0, "1:x")]
    found = audited(spark, rows)
    assert found == sorted(plain_audit(rows), key=repr) and len(found) == 6
    assert audited(spark, []) == []


def test_busy_coordinates_are_laid_out_in_copies(spark, monkeypatch):
    monkeypatch.setattr(merkle, "SHARED", 2)
    rows = [(k, "a" if k % 3 else "b", None, k, str(k)) for k in range(600)]
    assert audited(spark, rows) == sorted(plain_audit(rows), key=repr)


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_path(tokencounts.MODEL))


@pytest.fixture(scope="module")
def machine():
    return transducer.Transducer(transducer.vocabulary(public_path(tokencounts.MODEL)))


def texts_of_all_kinds(machine):
    draw = random.Random(3)
    pieces = list(machine.scores)
    alphabets = [machine.letters[5:], "aeinst ", " \n\t.▁a", "ab", "日本語é😀\x00ŕ"]
    out = ["", " ", "  a", "</s> <s> <unk>", "<0x41>", "▁▁x", "﻿a", "é"]
    out += ["".join(draw.choice(a) for _ in range(draw.randint(1, 90))) for a in alphabets for _ in range(400)]
    return out + ["".join(draw.choice(pieces).replace("▁", " ") for _ in range(draw.randint(1, 30))) for _ in range(800)]


def test_counts_are_the_library_s(machine, library):
    texts = texts_of_all_kinds(machine)
    assert machine.count(texts).tolist() == [len(x) for x in library.encode(texts, num_threads=1)]


def test_long_texts_without_a_place_of_rest(machine, library):
    draw = random.Random(4)
    long = ["a" * 1_200_003, "aab" * 90_000, " " * 70_001, "=-" * 60_000, "".join(draw.choice("aeinst") for _ in range(150_000)), "日本の語は" * 30_000, "two words " * 150_000]
    assert machine.count(["x", *long, "", "y"]).tolist() == [len(x) for x in library.encode(["x", *long, "", "y"], num_threads=1)]


def test_a_small_table_is_begun_anew(library):
    small = transducer.Transducer(transducer.vocabulary(public_path(tokencounts.MODEL)), states=50)
    texts = [f"word{k} another {k * k}" for k in range(200)]
    assert [int(small.count([t])[0]) for t in texts] == [len(x) for x in library.encode(texts, num_threads=1)]


def test_token_counts_of_odd_rows(spark, library):
    rows = [(1, None), (2, ""), (3, "héllo wörld"), (3, "héllo wörld"), (None, "x y"), (4, "tok " * 5000)]
    df = spark.createDataFrame([(i, t, None, "s", 0, "clash", 1, "clash") for i, t in rows], DOCS)
    found = {tuple(r) for r in tokencounts.token_counts(df).collect()}
    assert found == {(i, len((t or "").encode()), n := len(library.encode(t or "")), n > 4096) for i, t in rows}
    assert tokencounts.token_counts(df.limit(0)).count() == 0
    text_ids = spark.createDataFrame([("a", "b c")], "doc_id string, text string")
    assert tokencounts.token_counts(text_ids).first().doc_id == "a"


CLICKS = "click_id bigint, ts timestamp_ntz, arrived_at timestamp_ntz, client_id bigint, kind string, value double, props string"
SALES = "sale_id bigint, client_id bigint, status string, total double, sold_at timestamp_ntz, arrived_at timestamp_ntz, priority int"
LINES = "sale_id bigint, line_no int, item_id bigint, vendor_id bigint, quantity int, amount double, discount double, flag string, shipped_at timestamp_ntz"
NAMES = ["sale_id", "d", "t_us", "label", "last_click_id", *pointintime.SUMS]


def shop(seed, n=400):
    draw, start = random.Random(seed), datetime(2024, 3, 1)
    moment = lambda: start + timedelta(hours=draw.randint(0, 30 * 24)) if draw.random() > 0.02 else None
    late = lambda at: None if at is None or draw.random() < 0.02 else at + timedelta(minutes=draw.choice([0, 1, 300, 4000, 30000]))
    money = lambda: draw.choice([None, 0.005, 1.25, 10.1, -3.3, 99.995, float("nan")])
    client = lambda: draw.choice([7, 7, 7, 1, 2, None, 3])
    clicks, sales, lines = [], [], []
    for k in range(n):
        at = moment()
        row = (draw.choice([k, k // 2, None]), at, late(at), client(), draw.choice(["purchase", "view", None]), money(), draw.choice([None, "", "{}"]))
        clicks += [row] * draw.choice([1, 1, 1, 3])
        at = moment()
        sales.append((k, client(), "done", money(), at, late(at), 1))
        lines += [(draw.choice([k, 5, 5, None]), j, draw.choice([1, 2, None, draw.randint(3, 40)]), 0, 1, money(), 0.0, "x", late(at)) for j in range(draw.randint(0, 4))] * draw.choice([1, 1, 2])
    return sales, lines, clicks


def wanted(sales, lines, clicks):
    """The contract, sale by sale."""
    day, out = timedelta(days=1), []
    cents = lambda values: sum(int((100 * x + 0.5) // 1) for x in values if x is not None and x == x)
    clicks = set(map(lambda c: tuple("nan" if x != x else x for x in c), clicks))
    clicks = [tuple(None if x == "nan" else x for x in c) for c in clicks]
    for s in sales:
        if s[1] is None or s[4] is None:
            continue
        t = s[4] + timedelta(seconds=zlib.crc32(str(s[0]).encode()) % 259200)
        known = lambda at, arrived: at is not None and arrived is not None and t - d * day < at <= t and arrived + timedelta(minutes=240) <= t  # noqa: B023, E731
        label = any(o[1] == s[1] and o[4] is not None and t < o[4] <= t + 7 * day for o in sales)
        for d in (2, 14):
            c = [x for x in clicks if x[3] == s[1] and known(x[1], x[2])]
            o = [x for x in sales if x[1] == s[1] and known(x[4], x[5])]
            own = [x for y in o for x in lines if x[0] == y[0] and x[8] is not None and x[8] <= t]
            last = max(((x[1], -1 if x[0] is None else x[0]) for x in c), default=(0, -1))[1]
            out.append((s[0], d, int((t - datetime(1970, 1, 1)) / timedelta(microseconds=1)), label, None if last == -1 else last, len(c), sum(x[4] == "purchase" for x in c), cents(x[5] for x in c), len(o), cents(x[3] for x in o), len(own), cents(x[5] for x in own), len({x[2] for x in own} - {None})))
    return sorted(out, key=repr)


def frames(spark, sales, lines, clicks):
    return [spark.createDataFrame(rows, kind).repartition(3) for rows, kind in ((sales, SALES), (lines, LINES), (clicks, CLICKS))]


@pytest.mark.parametrize("limit", [20_000, 60])
def test_features_against_brute_force(spark, limit):
    """With a limit of 60 nearly all clients are cut into chunks of time."""
    data = shop(limit)
    found = pointintime.features(*frames(spark, *data), limit=limit)
    assert sorted((tuple(r) for r in found.select(*NAMES).collect()), key=repr) == wanted(*data)


def test_features_do_not_depend_on_the_zone_or_the_buffer(spark, monkeypatch):
    data = frames(spark, *shop(9, 150))
    first = sorted(map(repr, pointintime.features(*data).select(*NAMES).collect()))
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    monkeypatch.setattr(pointintime, "BUFFER", 50)
    assert sorted(map(repr, pointintime.features(*data, limit=100).select(*NAMES).collect())) == first
    spark.conf.set("spark.sql.session.timeZone", zone)


def test_features_of_empty_tables_and_further_columns(spark):
    sales, lines, clicks = frames(spark, *shop(2, 30))
    assert pointintime.features(sales.limit(0), lines, clicks).count() == 0
    alone = pointintime.features(sales, lines.limit(0), clicks.limit(0))
    assert alone.count() > 0 and alone.where("n_clicks > 0 OR n_lines > 0").count() == 0
    clash = [df.selectExpr("*", "'x' AS ts_", "1 AS slot", "2 AS base", "3 AS client") for df in (sales, lines, clicks)]
    assert sorted(map(repr, pointintime.features(*clash).collect())) == sorted(map(repr, pointintime.features(sales, lines, clicks).collect()))


def test_oracles_agree_with_the_operators(spark):
    con = duckdb.connect()
    for name in ("documents", "sales", "sale_lines", "clicks"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '/root/testdata/sf0.001/{name}.parquet'")
    from ledgerline.llm import queries

    for name in ("op11_merkle", "op13_point_in_time"):
        df = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
        assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, con.sql(f"SELECT {', '.join(df.columns)} FROM ({queries.ORACLES[name]})").fetchall()))
