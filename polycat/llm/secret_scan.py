"""Secrets in texts: patterns, and a convolutional network over the characters of further candidates."""

from __future__ import annotations

import functools
import hashlib
import random
import re
import string
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Patterns of the base findings and of candidates.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST = 16
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_.=-]{{{LEAST},}}")
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "model")

#: Characters of a window: before the candidate, of the candidate (longer ones are seen in several windows), after it.
LEFT, MIDDLE, RIGHT = 24, 64, 8
WINDOW = LEFT + MIDDLE + RIGHT
DIM, WIDTH, FILTERS = 8, 5, 24
#: Share of labelled secrets that the threshold must find.
RECALL = 0.98
#: Documents, and windows of their candidates, that a task looks at together.
TEXTS, WINDOWS = 256, 512


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, where the secret itself starts) of the patterns' findings, in order of start, then kind."""
    out = []
    low = text.lower()
    if any(w in low for w in WORDS):
        out += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(out)


def candidates(text: str, base: list[tuple[int, int, int, int]]) -> list[tuple[int, int]]:
    """All runs of 16 or more key characters, and of those that touch base findings the parts of 16 or more beside them."""
    out = []
    for m in CANDIDATE.finditer(text):
        at, end = m.span()
        for s, _, e, _ in base:  # in order of their starts
            if s < end and e > at:
                if s - at >= LEAST:
                    out.append((at, s))
                at = max(at, e)
        if end - at >= LEAST:
            out.append((at, end))
    return out


def windows(text: str, start: int, end: int) -> list[bytes]:
    """The candidate's windows, of WINDOW bytes each; characters beyond ASCII are 1, what is missing is 0."""
    out = []
    for at in range(start, max(start + 1, end - MIDDLE // 2), MIDDLE // 2):
        part = text[max(0, at - LEFT) : at].rjust(LEFT, "\0") + text[at : min(end, at + MIDDLE)].ljust(MIDDLE, "\0") + text[min(end, at + MIDDLE) :][:RIGHT].ljust(RIGHT, "\0")
        out.append(part.encode("ascii", "replace").replace(b"?", b"\1"))
    return out


@dataclass
class Net:
    letters: np.ndarray  # (128, DIM)
    filters: np.ndarray  # (WIDTH * (DIM + 1), FILTERS); the last dimension of a place tells candidate from context
    out: np.ndarray
    bias: float
    slope: float = 1.0  # calibration: log odds are slope * output + shift
    shift: float = 0.0
    threshold: float = 0.5

    def patches(self, codes: np.ndarray) -> np.ndarray:
        x = np.empty((*codes.shape, DIM + 1), np.float32)
        x[..., :DIM] = self.letters[codes]
        x[..., DIM] = (np.arange(WINDOW) >= LEFT) & (np.arange(WINDOW) < LEFT + MIDDLE) & (codes > 0)
        return np.lib.stride_tricks.sliding_window_view(x, WIDTH, axis=1).transpose(0, 1, 3, 2).reshape(len(codes), WINDOW - WIDTH + 1, -1)

    def pooled(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        p = self.patches(codes)
        maps = np.maximum(p @ self.filters, 0)
        where = maps.argmax(axis=1)
        return p, maps, where, np.concatenate([maps.max(axis=1), maps.mean(axis=1)], axis=1)

    def raw(self, codes: np.ndarray) -> np.ndarray:
        return self.pooled(codes)[3] @ self.out + self.bias

    def chance(self, raw: np.ndarray) -> np.ndarray:
        """Calibrated probabilities of outputs."""
        return 1 / (1 + np.exp(-np.clip(self.slope * raw + self.shift, -40, 40)))


def findings(n: int, seed: int) -> tuple[list[tuple[str, int, int]], np.ndarray]:
    """n labelled findings (text, start, end) made by rule: keys in code and prose, and runs that are none, among them numbers, names, paths, addresses, identifiers and long words."""
    r = random.Random(seed)
    pick = lambda chars, k: "".join(r.choices(chars, k=k))
    one = lambda *x: r.choice(x)
    between = r.randrange
    low, up, dig = string.ascii_lowercase, string.ascii_uppercase, string.digits
    alnum, hexa = low + up + dig, "0123456789abcdef"
    syllable = lambda: one(pick("bcdfghklmnprstvwz", 1) + pick("aeiou", 1), pick("aeiou", 1) + pick("nrstlm", 1), one("sch", "tion", "ing", "ver", "the", "ung", "con", "ent", "ff", "schaft", "ity", "pf", "nd", "ation", "ment"), one("str", "pro", "ck", "ble", "act", "tor", "ist", "qu", "ex", "xy", "ph", "dge", "let", "ness", "mp", "oo", "ea", "ly", "ab", "inter"), pick(low, 1))
    word = lambda: "".join(syllable() for _ in range(between(1, 5)))
    words = lambda a, b: [word() for _ in range(between(a, b))]
    secrets = (
        lambda: pick(alnum, between(20, 65)),
        lambda: pick(alnum + "+/", between(27, 88)) + one("", "=", "=="),
        lambda: pick(alnum + "-_", between(20, 60)),
        lambda: one("sk", "pk", "ghx", "tok", "key", "npx", "glx", word()[:4]) + one("-", "_", ".") + pick(alnum, between(16, 49)),
        lambda: pick(low, 2) + up[between(0, 26)] + pick(alnum, between(18, 60)) + "." + pick(alnum + "-_", between(20, 50)) + one("", "." + pick(alnum + "-_", between(20, 50))),
        lambda: pick(dig, between(9, 13)) + "-" + pick(alnum, between(16, 36)),
        lambda: pick(low + dig, between(20, 50)),
        lambda: pick(up + dig, between(20, 50)),
        lambda: pick(up + "234567", one(16, 26, 32, 52)),
        lambda: pick(hexa.upper(), one(32, 40, 64)),
        lambda: pick(hexa, one(32, 40, 48, 64, 128)),
        lambda: "AKIA" + pick(up + dig, between(12, 17)),
        lambda: "-".join(pick(alnum, between(4, 9)) for _ in range(between(4, 7))),
        lambda: word().capitalize() + pick(dig, between(2, 5)) + pick("+/_.=-", 1) + pick(alnum, between(8, 20)),
    )
    others = (
        lambda: one("-", "_", ".", "/").join(words(3, 7)) + one("", pick(dig, between(1, 4))),
        lambda: "/" + "/".join(words(2, 6)) + one("", "/v" + pick(dig, 1), one(".html", ".py", ".json", ".tar.gz")),
        lambda: f"{between(1900, 2100)}-{between(10, 13)}-{between(10, 29)}T{between(10, 24)}.{between(10, 60)}.{pick(dig, between(1, 4))}",
        lambda: pick(dig, between(1, 4)) + "." + pick(dig, between(14, 40)),
        lambda: one("-", ".", "/", "_").join(pick(dig, between(1, 6)) for _ in range(between(4, 9))),
        lambda: pick(up, 2) + pick(dig, between(14, 26)),
        lambda: ".".join(words(2, 4)) + one(".com", ".org", ".example.net") + "/" + word() + one("", pick(dig, between(1, 6))) + one("", "/" + word()),
        lambda: "".join(words(4, 9)) + one("", pick(dig, between(1, 3))),
        lambda: "".join(w.capitalize() for w in words(3, 7)) + one("", pick(dig, between(1, 3)), "Impl"),
        lambda: word() + "".join(w.capitalize() for w in words(3, 6)),
        lambda: one("", "get", "is", "I", "My", "to") + "".join(w.capitalize() for w in words(3, 9))[: between(16, 48)],
        lambda: one(*alnum) * between(16, 60),
        lambda: "_".join(words(3, 6)).upper() + one("", "_" + pick(dig, between(1, 3))),
        lambda: f"{word()}-{between(0, 9)}.{between(0, 20)}.{between(0, 20)}" + one(".tar.gz", "-py3-none-any.whl", ".dist-info/METADATA", "-linux_x86_64.whl"),
        lambda: one("=", "-", "_", ".", "+") * between(16, 60),
        lambda: one("=", "-", ".") * between(5, 20) + word() + one("=", "-", ".") * between(5, 20),
        lambda: "-".join(pick(hexa, k) for k in (8, 4, 4, 4, 12)),
        lambda: "+".join(f"{word()}{between(0, 100)}" for _ in range(between(3, 6))),
        lambda: "=".join([word(), word() + "/" + word(), word() + pick(dig, 2)]),
        lambda: one(*(low[i : i + 2] for i in range(20))) * between(8, 20),
        lambda: "".join(words(6, 8)).capitalize() + "-" + word().capitalize(),
        lambda: f"data/{word()}/part-{pick(dig, 5)}-{word()}.{word()[:4]}.parquet",
    )
    assign = lambda: one("password", "passwd", "secret", "token", "api_key", "apikey", "API_KEY", "Password") + one("", '"', "'") + one("", " ") + one("=", ":") + one("", " ") + one("", '"', "'")
    leads = ("key: ", 'key = "', "Authorization: Bearer ", "export KEY=", '"credential": "', "auth=", "pwd: ", "client ", "private key ", "id: ", "value ", "use ", "const k = '", "-H 'X-Auth: ", "")
    plain = ("see ", "file ", "http://", "https://www.", "version ", "id ", '"', "path: ", "key: ", "name = ", "import ", "in ", "call ", "from ", "", "", "(")
    out, labels = [], np.array([r.randrange(2) for _ in range(n)])
    for y in labels:
        before, after = " ".join(words(1, 7)), " ".join(words(1, 5))
        run, lead = one(*(secrets if y else others))(), one(*(leads if y and r.random() < 0.7 or r.random() < 0.3 else plain))
        if r.random() < 0.15:  # what the pattern of assignments finds may be shorter
            lead, run = assign(), pick(alnum, between(8, 24)) if y else "".join(words(3, 5)) + "e" * 8
        while len(run) < 16 and lead in (*leads, *plain):
            run += word()
        text = f"{before}{one(' ', chr(10), '. ')}{lead}"
        out.append((f"{text}{run}{one(' ', chr(34), '. ', ', ', chr(10), chr(39) + ';', ')')}{after}", len(text), len(text) + len(run)))
    return out, labels


def encode(found: list[tuple[str, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Windows of findings as codes and which finding each belongs to."""
    parts = [windows(*f) for f in found]
    owner = np.repeat(np.arange(len(found)), [len(p) for p in parts])
    return np.frombuffer(b"".join(x for p in parts for x in p), np.uint8).reshape(-1, WINDOW), owner


def fit(made: list[tuple[str, int, int]], y: np.ndarray, epochs: int, seed: int) -> Net:
    """A network fitted to labelled findings."""
    r = np.random.default_rng(seed)
    net = Net(r.normal(0, 0.3, (128, DIM)).astype(np.float32), r.normal(0, 0.15, (WIDTH * (DIM + 1), FILTERS)).astype(np.float32), np.zeros(2 * FILTERS, np.float32), 0.0)
    codes, owner = encode(made)
    y = y[owner]
    values = [net.letters, net.filters, net.out]
    speed = [np.full(v.shape, 1e-4, np.float32) for v in values]
    for epoch in range(epochs):
        rate, order = 0.05 / (1 + 0.5 * epoch), r.permutation(len(codes))
        for lo in range(0, len(order), 64):
            some = order[lo : lo + 64]
            p, maps, where, act = net.pooled(codes[some])
            dz = ((1 / (1 + np.exp(-np.clip(act @ net.out + net.bias, -40, 40))) - y[some]) / len(some)).astype(np.float32)
            dact = dz[:, None] * net.out
            dmaps = np.repeat(dact[:, None, FILTERS:] / maps.shape[1], maps.shape[1], axis=1)
            rows, cols = np.arange(len(some))[:, None], np.arange(FILTERS)[None]
            dmaps[rows, where, cols] += dact[:, :FILTERS]
            dmaps *= maps > 0
            dfilters = p.reshape(-1, p.shape[2]).T @ dmaps.reshape(-1, FILTERS)
            dp = (dmaps @ net.filters.T).reshape(len(some), maps.shape[1], WIDTH, DIM + 1)[..., :DIM]
            at = np.zeros((len(some), WINDOW, DIM), np.float32)
            for j in range(WIDTH):
                at[:, j : j + maps.shape[1]] += dp[:, :, j]
            where_of = codes[some].ravel()
            dletters = np.stack([np.bincount(where_of, at[..., d].ravel(), 128) for d in range(DIM)], axis=1).astype(np.float32)
            for v, g, s in zip(values, (dletters, dfilters, act.T @ dz), speed, strict=True):
                s += g * g
                v -= rate * g / np.sqrt(s)
            net.bias -= rate * float(dz.sum())
    return net


def calibrate(net: Net, found: list[tuple[str, int, int]], y: np.ndarray, recall: float = RECALL) -> None:
    """Sets the network's calibration by labelled findings that it wasn't fitted to (Newton steps of a logistic regression of the label on the output), and the highest threshold that finds `recall` of the secrets among them."""
    raw = best(net, found)
    x = np.stack([raw, np.ones(len(raw))], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        h = x.T @ (x * (p * (1 - p) + 1e-6)[:, None])
        w -= np.linalg.solve(h, x.T @ (p - y) + 1e-3 * (w - [1.0, 0.0]))
    net.slope, net.shift = float(max(w[0], 1e-3)), float(w[1])  # a larger output never lowers the chance
    chances = np.sort(net.chance(raw[y == 1]))
    net.threshold = float(chances[int((1 - recall) * len(chances))])


@functools.lru_cache(maxsize=4)
def train(n: int = 6000, epochs: int = 6, seed: int = 10) -> Net:
    """A network fitted to n labelled findings and calibrated by n / 3 others; the same arguments give the same one, made once in a process."""
    net = fit(*findings(n, seed), epochs, seed)
    calibrate(net, *findings(n // 3, seed + 1))
    return net


def best(net: Net, found: list[tuple[str, int, int]]) -> np.ndarray:
    """The largest output of each finding's windows, a bounded number of windows at a time."""
    out = np.full(len(found), -np.inf)
    for at in range(0, len(found), WINDOWS):
        codes, owner = encode(found[at : at + WINDOWS])
        for lo in range(0, len(codes), WINDOWS):
            np.maximum.at(out, at + owner[lo : lo + WINDOWS], net.raw(codes[lo : lo + WINDOWS]))
    return out


def scan(docs: DataFrame, net: Net | Callable[[], Net], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_assign, n_access, n_hex, n_model, base_sha256, spans, chances for each row of docs.

    The network looks at every base finding and every further candidate with its context. spans: kind:start:end of the
    base findings, all of them, and of the candidates whose chance is the network's threshold or more, in code points,
    by start, then kind, joined by commas; chances: the calibrated chance of each of them in the same order. Null and
    empty texts have none; very long texts are scanned whole; ids of any kind, nulls and repeated rows pass through,
    each with its own answer; an empty table gives no rows. One scan, no shuffle; a few documents are held at a time.
    net may be a function that gives the network, which is not called for an empty table.
    """
    if not isinstance(net, Net):
        net = Net(*[np.zeros(s, np.float32) for s in ((128, DIM), (WIDTH * (DIM + 1), FILTERS), 2 * FILTERS)], 0.0) if docs.isEmpty() else net()
    sent = docs.sparkSession.sparkContext.broadcast(net)  # some tens of KB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), TEXTS):
                part = batch.slice(lo, TEXTS)
                texts = [t or "" for t in part.column(1).to_pylist()]
                base = [base_spans(t) for t in texts]
                every = [sorted([*b, *((s, 3, e, s) for s, e in candidates(t, b))]) for t, b in zip(texts, base, strict=True)]
                chance = iter(sent.value.chance(best(sent.value, [(t, v, e) for t, x in zip(texts, every, strict=True) for _, _, e, v in x])))
                scored = [[(s, k, e, next(chance)) for s, k, e, _ in x] for x in every]
                kept = [[x for x in some if x[1] < 3 or x[3] >= sent.value.threshold] for some in scored]
                counts = [pa.array([sum(k == kind for _, k, _, _ in x) for x in kept], pa.int64()) for kind in range(4)]
                digests = [hashlib.sha256(_said(b).encode()).hexdigest() for b in base]
                spans = [_said(some) for some in kept]
                chances = [",".join(f"{x[3]:.4f}" for x in some) for some in kept]
                yield pa.RecordBatch.from_arrays([part.column(0), *counts, *(pa.array(x, pa.string()) for x in (digests, spans, chances))], [id_col, "n_assign", "n_access", "n_hex", "n_model", "base_sha256", "spans", "chances"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_assign long, n_access long, n_hex long, n_model long, base_sha256 string, spans string, chances string")


def _said(spans: list[tuple]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, _ in spans)
