import textwrap
from pathlib import Path

import pytest

from streamchain.llm import licenses
from streamchain.llm.license_texts import TEXTS

from . import data

COMMON = Path("/usr/share/common-licenses")


def test_whole_texts_and_notices(spark):
    mit = next(t for i, k, t in licenses.KNOWN if (i, k) == ("MIT", "text"))
    spelled = mit.replace("<year> <holder>", "2019 Someone, Inc.").replace("sublicense", "SUB-LICENSE").replace("\n\n", "\n   ** \n").upper()
    rows = [(1, mit), (2, spelled), (3, mit + " more"), (4, "prose\n# Licenced under the APACHE LICENSE version 2.0\nprose"), (5, "Released under the MIT Licence\nLicensed under CC BY-NC 4.0."), (6, None), (7, ""), (7, "")]
    got = sorted((r.doc_id, r.license_id, r.notices) for r in licenses.scan(spark, data.plain_docs(spark, rows)).collect())
    assert [g[:2] for g in got] == [(1, "MIT"), (2, "MIT"), (3, None), (4, None), (5, None), (6, None), (7, None), (7, None)]
    assert [g[2] for g in got][3:5] == ["Apache-2.0", "CC-BY-NC-4.0,MIT"]


def test_hard_and_no_documents(spark):
    got = licenses.scan(spark, data.hard_docs(spark)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in data.hard_rows()) and not any(r.license_id or r.notices for r in got)
    assert licenses.scan(spark, data.no_docs(spark)).collect() == []
    assert licenses.scan(spark, data.plain_docs(spark, [(1, "Licence")]), known=()).collect()[0].license_id is None


def test_every_text_however_it_is_wrapped_and_commented(spark):
    forms = [("", "", "", 70), ("# ", "", "", 60), ("// ", "", "", 77), (" * ", "/*\n", "\n */", 64), ("-- ", "", "", 50), ("| ", "+----+\n", "\n+----+", 90), ("", "", "", 33)]
    rows, want = [], {}
    for license_id, text in TEXTS:
        for k, (leader, begin, end, width) in enumerate(forms):
            lines = [x for line in text.replace("<year> <holder>", "2019-2024 Someone, and others").split("\n") for x in ([line] if "2019" in line else textwrap.wrap(line, width, break_long_words=False) or [""])]
            if k % 2:
                lines = [x for line in lines for x in ([line, "All rights reserved."] if line.startswith("Copyright (c) 2019") else [line])]
            want[len(rows)] = license_id
            rows.append((len(rows), begin + "\n".join((leader + x).rstrip() for x in lines) + end))
    assert len({i for i, _ in TEXTS}) >= 20
    assert {r.doc_id: r.license_id for r in licenses.scan(spark, data.plain_docs(spark, rows)).collect()} == want


def test_holders_of_several_lines(spark):
    mit = next(t for i, k, t in licenses.KNOWN if (i, k) == ("MIT", "text"))
    wrapped = "\n".join(x for line in mit.split("\n") for x in (textwrap.wrap(line, 40) or [""]))
    rows = [(k, text.replace("<year> <holder>", holder)) for text in (mit,) for k, holder in enumerate(("2019 A long company name,\nInc. and its affiliates", "2019 One\n  and two\n  and three", "2020\nSomeone"))]
    rows.append((3, wrapped.replace("<year> <holder>", "2021 The Society of\nAuthors")))
    assert {r.doc_id: r.license_id for r in licenses.scan(spark, data.plain_docs(spark, rows)).collect()} == dict.fromkeys(range(4), "MIT")


def test_sql_finds_the_same(spark, tmp_path):
    import duckdb

    from streamchain.llm.sql import LICENSES

    rows = [(k, "\n".join("// " + x for line in t.split("\n") for x in (textwrap.wrap(line, 40) or [""]))) for k, (_, t) in enumerate(TEXTS)] + [(100, "x\n# SPDX-License-Identifier: MIT\ny"), (101, None), (102, "(c) 2020 a\n© b\nCopyright\nCopyright it is")]
    docs = data.plain_docs(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents")
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents/*.parquet'")
    assert sorted(map(tuple, licenses.scan(spark, docs).select("doc_id", "digest", "license_id", "notices").collect())) == sorted(con.sql(LICENSES).fetchall())


def test_more_texts_than_are_broadcast(spark, monkeypatch):
    monkeypatch.setattr(licenses, "FEW_KNOWN", 20)
    docs = data.plain_docs(spark, [(1, TEXTS[0][1]), (2, "no")])
    assert {r.doc_id: r.license_id for r in licenses.scan(spark, docs).collect()} == {1: "MIT", 2: None}
    with pytest.raises(ValueError, match="notices"):
        licenses.scan(spark, docs, known=[("x", "notice", f"n {k}") for k in range(21)])


def test_notices_of_other_words(spark):
    known = (("CC0-1.0", "notice", "Dedicated to the public domain."), ("MIT", "notice", "MIT License."))
    rows = [(1, "a\n# dedicated to the PUBLIC domain\nb"), (2, "MIT Licence"), (3, "a\n\nb")]
    assert sorted((r.doc_id, r.notices) for r in licenses.scan(spark, data.plain_docs(spark, rows), known=known).collect()) == [(1, "CC0-1.0"), (2, "MIT"), (3, "")]


LONG = {
    "Apache-2.0": "Apache-2.0", "Artistic": "Artistic-1.0-Perl", "CC0-1.0": "CC0-1.0", "GFDL-1.2": "GFDL-1.2", "GFDL-1.3": "GFDL-1.3", "GPL-1": "GPL-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0",
    "LGPL-2": "LGPL-2.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0",
}


@pytest.mark.skipif(not COMMON.is_dir(), reason="the texts lie on some systems alone")
def test_long_texts_by_their_digests(spark):
    rows, want = [], {}
    for name, license_id in LONG.items():
        if not (COMMON / name).is_file():
            continue
        text = (COMMON / name).read_text()
        forms = [text, "\n".join("# " + line for line in text.split("\n")), text.replace("   Copyright [yyyy] [name of copyright owner]", "   Copyright 2021 Someone"), text.upper().replace("LICENSE", "LICENCE")]
        end = "END OF TERMS AND CONDITIONS"
        forms += [text[: text.index(end) + len(end)] + "\n\n"] if end in text else []
        for form in forms:
            want[len(rows)] = license_id
            rows.append((len(rows), form))
        want[len(rows)] = None
        rows.append((len(rows), text[: len(text) // 2]))
    assert {r.doc_id: r.license_id for r in licenses.scan(spark, data.plain_docs(spark, rows)).collect()} == want


def test_digests_of_a_caller(spark):
    docs = data.plain_docs(spark, [(1, "Some  terms.\nCopyright 2020 a"), (2, "Some terms, and more")])
    own = {r.doc_id: r.digest for r in licenses.scan(spark, docs, known=()).collect()}
    assert {r.doc_id: r.license_id for r in licenses.scan(spark, docs, known=[("own", "digest", own[1])]).collect()} == {1: "own", 2: None}
