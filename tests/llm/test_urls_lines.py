"""Temporal URL filter and line dedup against plain Python (their oracles run over whole tables)."""

import datetime as dt
import hashlib
import random
import re

import duckdb
import pytest

from tributary.llm import lines, queries, urls

DAY = dt.date(2024, 1, 1)


def day(n):
    return DAY + dt.timedelta(days=n)


def test_entries_count_only_while_listed(spark):
    log = spark.createDataFrame([
        ("a.example", day(5), "add"), ("a.example", day(10), "remove"), ("a.example", day(20), "add"),
        ("b.example/x", day(0), "add"), ("c.example", day(3), "add"), ("c.example", day(3), "remove"),
        (None, day(0), "add"), ("d.example", None, "add")], "entry string, at date, action string")
    caps = [(0, "http://www.a.example/p", 4), (1, "http://www.a.example/p", 5), (2, "https://u:p@A.example.:80/", 9),
            (3, "http://a.example", 10), (4, "http://a.example?x", 99), (5, "http://nota.example/", 6), (6, "http://b.example/x/y", 1),
            (7, "http://b.example/xy", 1), (8, "http://c.example/", 9), (9, None, 1), (10, "nonsense", 1), (11, "http://d.example", 5)]
    rows = [(i, u, day(n)) for i, u, n in caps] + [(12, "http://b.example/x", None), (1, "http://www.a.example/p", day(5))]
    df = spark.createDataFrame(rows, "page_id long, url string, fetched date").selectExpr("*", "1 as entry", "2 as spans", "3 as n")
    out = sorted((r.page_id, r.blocked) for r in urls.blocked(df, log).collect())
    assert out == sorted((i, i in (1, 2, 4, 6)) for i, _, _ in rows)
    assert not any(r.blocked for r in urls.blocked(df, log.limit(0)).collect())
    assert urls.blocked(df.limit(0), log).count() == 0


def brute(rows, k=8):
    """Rows of the operator by walking all passages in rank order; rows are ``(id, text)``."""
    fold = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
    deciding, out = {}, []
    cut = []
    for d, t in rows:
        at, found = 0, []
        for i, line in enumerate(re.split(r"\n|(?<=[.!?])[ \t\x0b\x0c\r]", t or "")):
            if w := line.encode().translate(fold).split():
                found.append((w, i, at, at + len(line)))
            at += len(line) + 1
        rank = (d is None, d or 0, int(hashlib.md5((t or "").encode()).hexdigest()[:15], 16))
        passages = []
        for n, (w, i, _, _) in enumerate(found):
            if len(w) >= k:
                runs = [(n, n + 1)]
            else:
                right = next((m for m in range(n + 1, len(found) + 1) if sum(len(u[0]) for u in found[n:m]) >= k), None)
                left = next((m for m in range(n, -1, -1) if sum(len(u[0]) for u in found[m:n + 1]) >= k), None)
                runs = [(n, right)] * (right is not None) + [(left, n + 1)] * (left is not None)
                if sum(len(u[0]) for u in found) < k:
                    runs = [(0, len(found))]
            for a, b in runs:
                words = tuple(x for u in found[a:b] for x in u[0])
                at_first = (*rank, found[a][1])
                passages.append((words, n, at_first))
                deciding[words] = min(deciding.get(words, at_first), at_first)
        cut.append((d, found, passages))
    for d, found, passages in cut:
        gone = sorted({found[n][2:] for words, n, rank in passages if rank > deciding[words]})
        out.append((d, len(found), len(gone), ",".join(f"{a}:{b}" for a, b in gone)))
    return sorted(out, key=str)


def found_in(df):
    return sorted(((r.doc_id, r.n_units, r.n_removed, r.removed) for r in df.collect()), key=str)


def test_line_dedup(frame):
    line = "a b c d e f g h"
    rows = [(3, f"{line}\nunique one two three four five six seven\n{line.upper()}"), (1, f"  A  b c d e f g\th \nshort\nshort"),
            (2, "short\nshort"), (5, None), (6, ""), (None, line), (4, "é" * 9 + f"\n{line}\n\n{line}"), (7, "x" * 100000 + "\n" + line),
            (8, f"Own words. Some. 1 2 3 4 5 6 7 8 9. {line}. More"), (9, f"Other. 1 2 3 4 5 6 7 8 9. {line}. . ")]
    df = frame([t for _, t in rows], [d for d, _ in rows]).selectExpr("*", "1 as units", "2 as digest", "3 as removed", "4 as row", "5 as text_key", "6 as d1")
    out = lines.repeated_units(df)
    assert found_in(out) == brute(rows)
    assert lines.without(rows[0][1], next(r.removed for r in out.collect() if r.doc_id == 3)) \
        == "unique one two three four five six seven\n"
    assert lines.repeated_units(frame([])).count() == 0
    twice = {r.doc_id: r.n_removed for r in lines.repeated_units(frame([line, line, line], [1, 1, 2])).collect()}
    assert twice == {1: 0, 2: 1}


def test_short_units_go_with_their_neighbours(frame):
    """A copied passage of short sentences goes whole; a short sentence that turns up elsewhere stays."""
    passage = "Yes! He said so. And then? Nothing at all. Not a word. He left. Rain fell on the town. So it went."
    rows = [(1, f"Alpha beta gamma delta epsilon zeta eta theta iota. {passage} Kappa lambda."),
            (2, f"One two three four five six seven eight nine ten.\n{passage}"), (3, f"{passage}\nMy own end of this text, in ten words or so."),
            (4, "Yes! That is quite another matter, as everybody in the room knew. He left."), (5, "Yes!"), (6, "yes!"), (7, "He left.\nYes!")]
    got = {r[0]: r for r in found_in(lines.repeated_units(frame([t for _, t in rows], [d for d, _ in rows])))}
    assert sorted(got.values(), key=str) == brute(rows)
    assert got[1][2] == 0 and got[4][2] == 0 and got[5][2] == 0 and got[6][2] == 1 and got[7][2] == 0
    assert lines.without(rows[1][1], got[2][3]).strip() == "One two three four five six seven eight nine ten."
    assert lines.without(rows[2][1], got[3][3]).strip() == "My own end of this text, in ten words or so."


def test_rows_that_share_an_id_stay_apart(frame):
    rows = [(1, "a b c d e f g h"), (1, "a b c d e f g h\nand something of its own here, yes"), (1, "a b c d e f g h"),
            (None, "a b c d e f g h"), (None, None)]
    df = frame([t for _, t in rows], [d for d, _ in rows])
    assert found_in(lines.repeated_units(df)) == brute(rows) and len(brute(rows)) == 5


def test_random_short_units(frame):
    rng = random.Random(7)
    pool = [" ".join(rng.choice("abcdef") for _ in range(rng.randrange(1, 12))) for _ in range(40)]
    rows = [(i // 2, "".join(rng.choice(pool) + rng.choice(["\n", ". ", "! ", "?\t", ".\r", "\n\n", ".", " . "])
                             for _ in range(rng.randrange(0, 14)))) for i in range(120)]
    df = frame([t for _, t in rows], [d for d, _ in rows])
    assert found_in(lines.repeated_units(df)) == found_in(lines.repeated_units(df, bits=1 << 15)) == brute(rows)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_oracle(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = queries.QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    res = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    assert sorted(map(str, (tuple(r[names.index(c)] for c in cols) for r in res.fetchall()))) \
        == sorted(map(str, (tuple(r[c] for c in cols) for r in df.collect())))
