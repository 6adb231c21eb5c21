"""URL filter: rules, the link graph, and whole results against plain Python and SQL."""

import re
from collections import Counter, defaultdict

import duckdb
import pytest
from stratakit.llm.url_filter import RULES, SQL, host_edges, host_scores, judge, op13_link_graph_url_filter, rule_table, ruled
from tests.conftest import SF_DIR

SCHEMA = "page_id long, url string, html string, host string, path string, rule string, verdict string, rules int, score double, kind int"
LOWER = {i: i + 32 for i in range(65, 91)}


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(LOWER), re.match(r"[^?#]*", rest[len(host) :])[0]


def brute(rows):
    """``(page_id, host, path, rule, verdict)`` of all rows, and scores by host."""
    judged = []
    for page, url, _ in rows:
        host, path = parts(url)
        fit = [(len(h + p), v, h + p) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        judged.append((page, host, path, max(fit)[2] if fit else None, max(fit)[1] if fit else None))
    edges = Counter()
    for (_, host, *_), (_, _, html) in zip(judged, rows):
        found = {m.translate(LOWER) for m in re.findall(r"""<a\s(?:[^<>]*?\s)?href\s*=\s*["']?\s*(?:https?:)?//([^/?#\s"'<>]*)""", html or "", re.I | re.S)}
        edges.update((host, t) for t in found if t and host and t != host)
    scores = {}
    for kind, verdict in (("trust", "allow"), ("distrust", "block")):
        pages, seeded = Counter(r[1] for r in judged), Counter(r[1] for r in judged if r[4] == verdict)
        moves = defaultdict(list)
        for (s, t), n in edges.items():
            a, b = (s, t) if kind == "trust" else (t, s)
            moves[a].append((b, n / sum(m for e, m in edges.items() if e[kind != "trust"] == a)))
        moved = {h: n / pages[h] for h, n in seeded.items() if h}
        total = Counter(moved)
        for _ in range(50):
            got = Counter()
            for h, v in moved.items():
                for b, share in moves[h]:
                    got[b] += 0.85 * v * share
            moved = got
            total.update(got)
        scores[kind] = total
    out = [(*r[:4], r[4] or ("block" if scores["distrust"][r[1]] - scores["trust"][r[1]] > 0.5 else "allow")) for r in judged]
    return out, scores


def a(*links):
    return "<p>" + "".join(f'<A class="x"\n HREF = "{x}">t</a>' for x in links)


PAGES = [
    (1, "http://Good.Example.COM/de/1", a("https://friend.org/x", "/own", "//friend.org?q", "http://good.example.com/z")), (2, "http://friend.org", a("//deep.org/")), (3, "https://deep.org/es/", None),
    (4, "http://bad.net/es/1", ""), (5, "http://bad.net/fr/2?x=/en/", "no // link"), (6, "http://bad.net/en/3", a("http://elsewhere.io")), (7, "http://farm.org/1", a("http://bad.net/es/9", "HTTP://BAD.NET/fr")),
    (8, "http://farm.org/2#f", a("//bad.net")), (9, "http://feeder.org/", a("http://farm.org/1")), (10, "http://both.org/a", a("http://bad.net/es/1", "http://good.example.com/")), (11, "http://www.example.com/en/1", ""),
    (12, "http://example.com/en/1", "<a data-href='//no.org'><abbr href='//no.org'>"), (13, "http://a.www.example.com/en/x", None), (14, "http://notexample.com/en/x", ""), (15, "http://x.com", ""), (16, "http://x.com?/en/", ""),
    (17, None, a("http://bad.net")), (18, "no scheme", a("http://bad.net")), (19, "", ""), (None, "http:///path", a("http://bad.net")), (20, "http://com/", ""), (20, "http://com/", ""), (21, "a://b://c/d", ""), (22, "http://net/es/", ""), (23, "http://x..net/fr/", ""),
    (24, "http://" + "a." * 3000 + "net/es/", ""), (25, "http://both.org/b", a("http://friend.org")), (26, "http://lone.org/x\ny?z", ""), (27, "http://Ünï.com/EN/", ""),
    (28, "http://worst.net/es/1", ""), (29, "http://spam.org/", a("http://worst.net/es/1", "http://lone.org/")), (30, "http://ring.org/", a("http://spam.org")),
]


def frame(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "x", "y", "z", "w", 1, 2.0, 3) for r in rows], SCHEMA).repartition(3)


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, x) for x in r))


def test_verdicts_and_scores_against_brute_force(spark):
    want, scores = brute(PAGES)
    df = judge(frame(spark), rule_table(spark))
    assert df.columns == ["page_id", "host", "path", "rule", "verdict"] and ordered(df.collect()) == ordered(want)
    by = {r["host"]: r for r in host_scores(ruled(frame(spark), rule_table(spark)), host_edges(frame(spark))).collect()}
    assert by.keys() == {h for s in scores.values() for h, v in s.items() if v}
    for h, r in by.items():
        assert r["trust"] == pytest.approx(scores["trust"][h], abs=1e-4) and r["distrust"] == pytest.approx(scores["distrust"][h], abs=1e-4)
    verdict = {p: v for p, *_, v in want}
    assert {verdict[p] for p in (6, 29, 30)} == {"block"} and {verdict[p] for p in (2, 3, 7, 9, 10, 26)} == {"allow"}


def test_no_rows_no_rules_and_no_links(spark):
    assert judge(frame(spark, PAGES[:1]).limit(0), rule_table(spark)).collect() == []
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert {(r["rule"], r["verdict"]) for r in judge(frame(spark), none).collect()} == {(None, "allow")}
    tied = spark.createDataFrame([("org", "", "allow"), ("org", "", "block")], none.schema)
    assert {r["verdict"] for r in ruled(frame(spark), tied).collect() if r["host"].endswith("org")} == {"block"}


def sql_rows(path):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{path}'")
    relation = con.sql(SQL)
    at = [relation.columns.index(c) for c in ("page_id", "host", "path", "rule", "verdict")]
    return ordered(tuple(r[i] for i in at) for r in relation.fetchall())


def test_query_equals_its_sql(spark, tmp_path):
    assert ordered(op13_link_graph_url_filter(spark, SF_DIR).collect()) == sql_rows(f"{SF_DIR}/pages.parquet")
    frame(spark).write.parquet(f"{tmp_path}/pages.parquet")
    assert ordered(op13_link_graph_url_filter(spark, str(tmp_path)).collect()) == sql_rows(f"{tmp_path}/pages.parquet/*.parquet")
