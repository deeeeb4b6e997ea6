"""Licences in several spellings, whole texts of long ones, and what is none."""

import os
import re

import pytest
from pyspark.sql import functions as F
from test_small_tables import docs, empty

from polycat.llm import license_scan as L

#: Texts that Debian systems keep, by the names that DIGESTS gives them.
SYSTEM = "/usr/share/common-licenses"
FILES = {"Apache-2.0": "Apache-2.0", "Artistic-1.0": "Artistic", "BSD-3-Clause-UC": "BSD", "CC0-1.0": "CC0-1.0", "GFDL-1.2": "GFDL-1.2", "GFDL-1.3": "GFDL-1.3", "GPL-1.0": "GPL-1", "GPL-2.0": "GPL-2", "GPL-3.0": "GPL-3", "LGPL-2.0": "LGPL-2", "LGPL-2.1": "LGPL-2.1", "LGPL-3.0": "LGPL-3", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0"}


def found(spark, rows):
    return {r.doc_id: r.license_id for r in L.scan_licenses(docs(spark, rows), L.known_licenses(spark)).collect()}


def spellings(text):
    """The text in lower and upper case, rewrapped, in comments, with other punctuation and with other copyright lines."""
    body = re.sub(r"(?m)^.*copyright \(c\).*$", "", text, flags=re.IGNORECASE)
    return [
        text,
        text.upper(),
        text.lower().replace('"', "''").replace(",", " ,"),
        re.sub(r"(?m)^", " * ", text),
        "\n\n".join(" ".join(p.split()) if not re.match(r"\s*[0-9]\.", p) else p for p in text.split("\n\n")),
        re.sub(r"(?<!\n)\n(?![\n0-9])", "\r\n", text),
        "Copyright (c) 2019-2024 Some One <some@one.example>. All rights reserved.\n© 2020 Other\n(c) 2021 Third, Inc.\n" + body,
    ]


def test_short_licenses(spark):
    rows, want = [], {}
    for name, text in L.LICENSES.items():
        for s in spellings(text):
            want[len(rows)] = name
            rows.append((len(rows), s))
    got = found(spark, rows)
    assert {i: (want[i], got[i]) for i in want if got[i] != want[i]} == {}


def test_one_line(spark):
    """Without line breaks a copyright notice ends where the licence begins."""
    mit = " ".join(L.LICENSES["MIT"].replace("<year> <copyright holders>", "2020 Some One").split())
    assert "Copyright (c) 2020 Some One Permission is" in mit
    british = mit.replace("sublicense", "sub-licence").replace("MIT License", "The MIT Licence (MIT)").replace("NONINFRINGEMENT", "NON-INFRINGEMENT")
    assert found(spark, [(1, mit), (2, british), (3, mit.replace("(c) 2020", "© 2020"))]) == {1: "MIT", 2: "MIT", 3: "MIT"}


@pytest.mark.skipif(not os.path.isdir(SYSTEM), reason="no licence texts on this system")
def test_long_licenses(spark):
    assert set(FILES) == set(L.DIGESTS)
    texts = {k: open(f"{SYSTEM}/{v}", encoding="utf-8").read() for k, v in FILES.items() if os.path.exists(f"{SYSTEM}/{v}")}
    rows, want = [], {}
    for name, t in texts.items():
        for s in (t, t.upper(), t.replace("license", "licence").replace("ization", "isation"), t.replace("\n", "\r\n"), re.sub(r"[ \t]+", "  ", t)):
            want[len(rows)] = name
            rows.append((len(rows), s))
    for name in L.BARE:  # without what comes after the terms
        want[len(rows)] = name
        rows.append((len(rows), re.split(r"(?i)(?<=END OF TERMS AND CONDITIONS)", texts[name])[0]))
    for old in ("59 Temple Place, Suite 330, Boston, MA  02111-1307  USA", "675 Mass Ave, Cambridge, MA 02139, USA"):
        want[len(rows)] = "GPL-2.0"
        rows.append((len(rows), re.sub(r"51 Franklin Street, Fifth Floor,\s+Boston, MA 02110-1301,? USA", old, texts["GPL-2.0"])))
        assert old in rows[-1][1]
    assert found(spark, rows) == want


def test_notices(spark):
    """Notices of any length, without sign or year, identifiers, and organisations in the clause on names."""
    mit, bsd = L.LICENSES["MIT"], L.LICENSES["BSD-3-Clause"]
    line = next(x for x in mit.split("\n") if x.startswith("Copyright"))
    rows = [mit.replace(line, "Copyright (c) 2020 " + "Some One and " * 60 + "Others"), mit.replace(line, "Copyright The Authors"), "// SPDX-License-Identifier: MIT\n" + mit, mit.replace(line, "# Copyright by the people who wrote it")]
    named = bsd.replace("the copyright holder nor the names of its", "Example Org nor the names of its")
    assert named != bsd
    assert found(spark, list(enumerate([*rows, named, named.replace("nor the names of its", "and the names of its")]))) == {0: "MIT", 1: "MIT", 2: "MIT", 3: "MIT", 4: "BSD-3-Clause", 5: None}


def test_no_licenses(spark):
    """More than the licence, less, other words, notices in prose, nothing, repeated rows and rows without id."""
    mit = L.LICENSES["MIT"]
    long_line = "Copyright (c) 2020 " + "wort " * 100 + mit
    rows = [(1, mit + " and more"), (2, mit[: len(mit) // 2]), (3, mit.replace("free of charge", "for a fee")), (4, "This is under the MIT License."), (5, None), (6, ""), (7, " .,;\n"), (8, long_line), (9, "MIT License"), (None, L.LICENSES["ISC"]), (None, "x"), (10, mit), (10, mit)]
    out = L.scan_licenses(docs(spark, rows), L.known_licenses(spark)).collect()
    assert sorted((r.doc_id or 0, r.license_id or "") for r in out) == sorted((i or 0, {None: "ISC", 8: "MIT", 10: "MIT"}.get(i, "") if t != "x" else "") for i, t in rows)
    assert L.scan_licenses(empty(spark), L.known_licenses(spark)).count() == 0


def test_own_licenses(spark):
    own = spark.createDataFrame([("b", "Use it."), ("a", "USE IT!"), ("c", " "), ("d", None)], "license_id string, license_text string")
    assert [tuple(r)[0] for r in L.digests(own).collect()] == ["a"]
    assert [r.license_id for r in L.scan_licenses(docs(spark, [(1, "use (it)")]), L.digests(own)).collect()] == ["a"]
    assert L.scan_licenses(docs(spark).withColumn("digest", F.lit(1)).withColumn("license_id", F.lit(2)), L.digests(own)).columns == ["doc_id", "digest", "license_id"]
