"""Queries that SQL can express give the rows of their SQL twin."""

import duckdb
import pytest

from vocabweave.llm import licences, url_filters
from vocabweave.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, name, folder):
    connection = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('/root/testdata/{folder}/{table}.parquet')")
    twin = connection.execute(ORACLES[name])
    columns = sorted(d[0] for d in twin.description)
    expected = sorted(map(tuple, twin.fetchdf()[columns].astype(object).where(lambda x: x.notna(), None).values), key=str)
    found = QUERIES[name](spark, f"/root/testdata/{folder}")
    assert sorted(found.columns) == columns
    rows = sorted(map(tuple, found.select(*columns).collect()), key=str)
    assert rows == expected and rows


def test_licence_sequences(documents):
    sentence = {name: own[0].capitalize() for name, own in licences.SENTENCES.items()}
    mit = f"MIT License\n\nCopyright (c) 2020 me.\n\n{sentence['mit-grant']}:\n\n{sentence['mit-notice']}.\nTHE {sentence['as-is'][4:]}!"
    rows = [
        (1, None), (2, ""), (3, mit), (4, "Released under the MIT License."), (4, "Released under the MIT License."),
        (5, sentence["bsd-source"] + ". " + sentence["bsd-redistribution"]), (6, "x. " * 50_000 + "Licensed under CC BY-NC 4.0"),
        (None, "all rights reserved."),
    ]
    found = sorted(map(tuple, licences.matches(documents(rows)).collect()), key=str)
    number = {(licence, len(own)): i for i, (licence, own) in enumerate(licences.RULES, 1)}
    assert [f for f in found if f[0] != 4] == sorted([
        (3, 1, 4, number["MIT", 3], "MIT"), (6, 50_001, 50_001, number["CC-BY-NC-4.0", 1], "CC-BY-NC-4.0"),
        (None, 1, 1, number["all rights reserved", 1], "all rights reserved"),
    ], key=str)
    # repeated rows are one text with the sentences of both
    assert {f for f in found if f[0] == 4} == {(4, 1, 1, number["MIT", 1], "MIT")}
    assert licences.matches(documents([])).count() == 0


def test_wrapped_licences_and_repeated_rows(documents):
    import textwrap

    own = lambda *names: [licences.SENTENCES[n][0] for n in names]
    wrap = lambda text, leader="", end="\n": end.join(leader + line for line in textwrap.wrap(text, 72))
    mit = "\n\n".join(wrap(s.capitalize() + ".") for s in own("mit-grant", "mit-notice", "as-is", "no-liability"))
    bsd = "\n *\n".join(wrap(s.capitalize() + ":", " * ") for s in own("bsd-redistribution", "bsd-source", "bsd-binary"))
    isc = "Copyright me\r\n" + wrap(own("isc-grant")[0] + ".", "# ", "\r\n")
    apache, use = own("apache2-ref", "apache2-use")
    rows = [
        (1, "MIT License\n" + mit), (2, bsd), (2, bsd), (3, isc), (4, wrap(own("mit-notice")[0]).replace("\n", "\n\n")),
        (5, f"{apache}. All rights reserved. {use}."), (None, bsd), (None, bsd),
    ]
    found = sorted(((r.doc_id, r.licence, r.rule) for r in licences.matches(documents(rows).coalesce(1)).collect()), key=str)
    number = {(licence, len(sequence)): i for i, (licence, sequence) in enumerate(licences.RULES, 1)}
    kinds = [(1, "MIT", 4), (1, "MIT", 3), (2, "BSD-2-Clause", 3), (2, "BSD-2-Clause", 3), (3, "ISC", 1), (5, "Apache-2.0", 2), (None, "BSD-2-Clause", 3), (None, "BSD-2-Clause", 3)]
    assert found == sorted([(i, licence, number[licence, n]) for i, licence, n in kinds], key=str)


def test_url_parts_and_rules(spark):
    urls = [
        None, "", "no scheme", "HTTP://WWW.Example.ORG/EN/1", "http://example.org/en/12", "https://a.example.org/es/x?u=://z", "http://b.org?x=/fr/",
        "http://x.com/fr/", "http://x.com/de/7#f", "http://notorg/a", "http://x.net//a//b/", "http://x.net/" + "s/" * 5000,
    ]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate([*urls, urls[4]])] + [(None, "http://q.net/1", "x")], "page_id bigint, url string, n string")
    found = {(r.page_id): r for r in url_filters.judge(pages).collect()}
    assert len(found) == 14
    seen = [(found[i].host, found[i].path[:12], found[i].rule) for i in range(12)]
    assert seen == [
        ("", "", None), ("", "", None), ("", "", None), ("www.example.org", "/EN/1", "org/"), ("example.org", "/en/12", "example.org/en/1"),
        ("a.example.org", "/es/x", "example.org/es/"), ("b.org", "", None), ("x.com", "/fr/", "com/fr/"), ("x.com", "/de/7", "com/de/"),
        ("notorg", "/a", None), ("x.net", "//a//b/", None), ("x.net", "/s/s/s/s/s/s", None),
    ]
    assert found[4].verdict == "block" == found[8].verdict and found[3].verdict == "allow" == found[7].verdict
    assert {r.verdict for r in found.values()} <= {"allow", "block"}
    assert url_filters.judge(pages.limit(0)).count() == 0


def test_templates_learn_from_labelled_branches(spark):
    rows = [(i, f"http://s.com/{'de' if i % 3 else 'xx'}/{i}") for i in range(300)] + [(1000 + i, f"http://t.com/{'fr' if i % 3 else 'xx'}/{i}") for i in range(300)]
    found = url_filters.judge(spark.createDataFrame(rows, "page_id bigint, url string")).where("rule IS NULL")
    assert {(r.host, r.template, r.verdict) for r in found.collect()} == {("s.com", "/xx/*", "block"), ("t.com", "/xx/*", "allow")}


def test_literal_stars_are_no_wildcards(spark):
    urls = [f"http://x.net/a/{i}" for i in range(20)] + ["http://x.net/a/*"] * 10 + ["http://x.net/*", "http://x.net/", "http://x.net"] * 4
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    found = url_filters.judge(pages).collect()
    assert sorted(r.page_id for r in found) == list(range(len(urls)))
    connection = duckdb.connect()
    connection.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    connection.executemany("INSERT INTO pages VALUES (?, ?)", list(enumerate(urls)))
    names = ["page_id", "host", "path", "rule", "verdict", "template"]
    expected = connection.execute(f"SELECT {', '.join(names)} FROM ({url_filters.oracle()})").fetchall()
    assert sorted(tuple(r[n] for n in names) for r in found) == sorted(expected)
