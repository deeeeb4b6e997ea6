"""Base spans against a matcher of single characters, the network on findings of other making, and edges."""

import hashlib
import random
import string

import numpy as np
from pyspark.sql import functions as F
from test_small_tables import TEXTS, docs, empty

from polycat.llm import secret_scan as S

VALUE, UPPER, HEXA = set(string.ascii_letters + string.digits + "+/_.=-"), set(string.ascii_uppercase + string.digits), set("0123456789abcdef")


def run_from(t, at, allowed):
    while at < len(t) and t[at] in allowed:
        at += 1
    return at


def assign_at(t, at):
    """Where an assignment that starts here ends, and where its value starts; None if none does."""
    for word in ("password", "passwd", "secret", "token", "api_key", "apikey"):
        if t[at : at + len(word)].isascii() and t[at : at + len(word)].lower() == word:
            i = at + len(word)
            i += t[i : i + 1] in ('"', "'")
            while t[i : i + 1] == " ":
                i += 1
            if t[i : i + 1] not in (":", "="):
                return None
            i += 1
            while t[i : i + 1] == " ":
                i += 1
            i += t[i : i + 1] in ('"', "'")
            end = run_from(t, i, VALUE)
            return (end, i) if end > i else None
    return None


def brute(t):
    out, at = [], 0
    while at < len(t):
        found = assign_at(t, at)
        if found and found[0] - found[1] >= 8:
            out.append((at, 0, found[0]))
        at = found[0] if found else at + 1
    for kind, lead, allowed, least in ((1, "AKIA", UPPER, 16), (2, "", HEXA, 32)):
        at = 0
        while at < len(t):
            end = run_from(t, at + len(lead), allowed) if t.startswith(lead, at) else at
            if end > at + len(lead):
                if end - at >= least:
                    out.append((at, kind, end))
                at = end
            else:
                at += 1
    return sorted(out)


def pieces(seed, n):
    r = random.Random(seed)
    parts = ["password", "Passwd", "SECRET", "token", "api_key", "apikey", "api-key", "ſecret", '"', "'", " ", "  ", "\t", ":", "=", "==", "é", "\n", "AKIA", "akia", "x", "A", "abcdef12", "ABCDEF0123456789", "0123456789abcdef", "0123456789abcdef" * 2, "a.b/c-d_", ","]
    return ["".join(r.choice(parts) for _ in range(r.randint(0, 30))) for _ in range(n)]


def test_base_spans(spark):
    texts = pieces(1, 3000)
    rows = [(i, t) for i, t in enumerate(texts)] + [(5000 + i, t) for i, (_, t) in enumerate(TEXTS)]
    found = [len(brute(t or "")) for _, t in rows]
    assert sum(found) > 1000
    got = {x.doc_id: x for x in S.scan(docs(spark, rows), S.train(n=300, epochs=1)).collect()}
    for i, t in rows:
        want = brute(t or "")
        said = [",".join(f"{S.KINDS[k]}:{s}:{e}" for s, k, e in want)]
        assert [tuple(x[:3]) for x in S.base_spans(t or "")] == want, t
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(sum(k == x for _, k, _ in want) for x in range(3))
        assert got[i].base_sha256 == hashlib.sha256(said[0].encode()).hexdigest()
        every = [x for x in got[i].spans.split(",") if x]
        assert [x for x in every if not x.startswith("model:")] == [x for x in said[0].split(",") if x]
        assert len(got[i].chances.split(",")) == len(every) or not every and got[i].chances == ""
        assert got[i].n_model == len(every) - len(want)


def others(seed):
    """Labelled findings of formats and contexts that the library's generator does not have."""
    r = random.Random(seed)
    pick = lambda chars, k: "".join(r.choice(chars) for _ in range(k))
    alnum = string.ascii_letters + string.digits
    hexa, up, low, dig = "0123456789abcdef", string.ascii_uppercase, string.ascii_lowercase, string.digits
    yes = [
        "SG." + pick(alnum, 22) + "." + pick(alnum, 43), "glpat-" + pick(alnum, 20), "AIza" + pick(alnum + "_-", 35), "xoxp-" + pick(dig, 12) + "-" + pick(dig, 12) + "-" + pick(alnum, 32),
        pick(alnum + "/+", 40), "npm_" + pick(alnum, 36), pick(alnum + "+/", 64), "hvs." + pick(alnum, 90), "dop_v1_" + pick(hexa, 64), "EAAC" + pick(alnum, 100),
        "ghp_" + pick(alnum, 36), "github_pat_" + pick(alnum, 22) + "_" + pick(alnum, 59), "sk_live_" + pick(alnum, 24), "rk_test_" + pick(alnum, 32), "sq0csp-" + pick(alnum + "-_", 43),
        "shpat_" + pick(hexa, 32), "key-" + pick(hexa, 32), "AC" + pick(hexa, 32), "pypi-AgEIcHlwaS5vcmc" + pick(alnum + "-_", 60), "ya29." + pick(alnum + "-_", 68),
        "eyJhbGciOiJIUzI1NiJ9." + pick(alnum + "-_", 40) + "." + pick(alnum + "-_", 43), pick(dig, 10) + "-" + pick(alnum, 32), "ASIA" + pick(up + dig, 16), pick(alnum, 32), pick(alnum, 24),
        pick(up + "234567", 32), pick(hexa.upper(), 40), "lin_api_" + pick(alnum, 40), "dckr_pat_" + pick(alnum + "-_", 27), "tfp_" + pick(alnum, 44), "sntrys_" + pick(alnum + "+/", 60) + "=",
        "-".join(pick(alnum, 8) for _ in range(4)), pick(alnum + "-_", 43), pick(alnum + "+/", 86) + "==", "rdme_" + pick(low + dig, 70), "NRAK-" + pick(up + dig, 27),
    ]
    no = [
        "Donaudampfschifffahrtsgesellschaft", "internationalization", "org.apache.spark.sql.catalyst", "getUserByIdentifier2", "./usr/share/doc/python3", "2024-01-31T23.59.59.123456", "978-3-16-148410-0",
        "MAX_RETRY_COUNT_PER_HOST", "www.example.org/articles/2021/05/news", "------------------------", "numpy-1.26.4-cp312-cp312-manylinux.whl", "antidisestablishmentarianism", "3.14159265358979323846",
        "src/main/java/App.java", "kubernetes-dashboard-v2", "left_outer_join_on_key", "otorrinolaringologista", "Rechtsschutzversicherung", "constitutionnellement", "/var/log/nginx/access.log", "DE89370400440532013000",
        "en.wikipedia.org/wiki/Main_Page", "application/x-www-form-urlencoded", "AbstractSingletonProxyFactoryBean", "test_that_long_names_are_fine", "2021-03-04/2021-04-05", "win32-x64-unpacked.zip",
        "================", "a=b=c=d=e=f=g=h=i", "fr-FR/common/strings.json", "1234567890.1234567890", "mailing-list.archives.example", "commons-lang3-3.12.0.jar", "xxxxxxxxxxxxxxxxxxxx", "io.netty.handler.codec.http2",
    ]
    around = [("curl -u admin:", " https://host"), ("aws_secret_access_key ", "\n"), ("see also ", " for more"), ("the value ", " was set"), ("- ", "\n- next"), ("`", "`")]
    for y, runs in ((1, yes), (0, no)):
        for run in runs:
            a, b = r.choice(around)
            yield f"line before {a}{run}{b}", len("line before ") + len(a), len("line before ") + len(a) + len(run), y


def test_parts_beside_base_findings(spark):
    """What a run holds beside a base finding is seen too."""
    key = "ghp_" + "aB3xY9zQ7w" * 3 + "kL5m"
    hexa = "0123456789abcdef" * 2
    t = f"use {key}{'=' * 1}{hexa}.{key} here"
    base = S.base_spans(t)
    got = S.candidates(t, base)
    assert [t[s:e] for s, e in got] == [f"{key}=", f".{key}"] and [b[1] for b in base] == [2]
    assert S.candidates(f"{hexa}.short", S.base_spans(f"{hexa}.short")) == []
    row = S.scan(docs(spark, [(1, t)]), S.train()).first()
    assert (row.n_hex, row.n_model) == (1, 2)


def test_empty_table_trains_nothing(spark):
    def never():
        raise AssertionError

    assert S.scan(empty(spark), never).count() == 0


def test_network_on_other_findings():
    net = S.train()
    found = [x for seed in range(12) for x in others(seed)]
    chance = net.chance(S.best(net, [x[:3] for x in found]))
    y = np.array([x[3] for x in found])
    assert (chance[y == 1] >= net.threshold).mean() >= 0.9 and (chance[y == 0] >= net.threshold).mean() <= 0.02, {found[i][0] for i in np.flatnonzero((y == 0) & (chance >= net.threshold))}


def test_calibration():
    """Chances are close to the shares of secrets, and the threshold keeps the recall on findings that it wasn't set by."""
    net = S.train()
    found, y = S.findings(3000, seed=99)
    chance = net.chance(S.best(net, found))
    for lo in (0.0, 0.5, 0.8):
        some = (chance >= lo) & (chance < {0.0: 0.5, 0.5: 0.8, 0.8: 1.01}[lo])
        assert abs(y[some].mean() - chance[some].mean()) < (0.02 if lo != 0.5 else 0.25)
    assert (chance[y == 1] >= net.threshold).mean() >= S.RECALL - 0.015 and 0 < net.threshold < 1
    loose, strict = S.Net(net.letters, net.filters, net.out, net.bias), S.Net(net.letters, net.filters, net.out, net.bias)
    S.calibrate(loose, *S.findings(1000, seed=98), recall=0.5)
    S.calibrate(strict, *S.findings(1000, seed=98), recall=0.995)
    assert strict.threshold < loose.threshold


def test_edges(spark):
    key = "ghp_" + "aB3xY9zQ7w" * 3 + "kL5m"
    long = "wort " * 20_000 + key + " wort" * 20_000
    rows = [*TEXTS, (20, f"use {key} here"), (20, f"use {key} here"), (None, f"use {key} here"), (21, long), (22, "see file one-two-three-four there"), (23, key)]
    out = S.scan(docs(spark, rows).withColumn("spans", F.lit(1)), S.train()).collect()
    assert len(out) == len(rows)
    assert [(x.n_model, x.spans) for x in out if x.doc_id == 20] == [(1, f"model:4:{4 + len(key)}")] * 2
    assert [x.n_model for x in out if x.doc_id is None].count(1) == 1
    one = {x.doc_id: x for x in out}
    assert one[21].spans == f"model:100000:{100000 + len(key)}" and one[22].n_model == 0 and one[23].spans == f"model:0:{len(key)}"
    assert one[0].spans == one[0].chances == "" and one[0].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert (one[8].n_assign, one[8].n_access, one[8].n_hex) == (1, 1, 1)
    assert S.scan(empty(spark), S.train(n=300, epochs=1)).count() == 0
