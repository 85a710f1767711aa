"""Personal data: base patterns, and spans that gradient-boosted trees choose among high-recall candidates.

Base spans (email, ip, card, phone; leftmost, non-overlapping per kind, checked afterwards) always stay. Generators propose
further, overlapping spans: every stretch of up to GROUPS adjacent digit groups (as a phone, a card or a social security
number, by how many digits it has), spelled-out addresses, IPv6, account numbers (iban) and secrets (long mixed tokens, and
values after words such as password). Boosted trees score each from its format, its place among its neighbours and its
context; scores are calibrated, and each kind's threshold set to the lowest that keeps PRECISION (even odds at least), on
examples of formats that the trees have not seen. A span is taken if it reaches its kind's threshold, best score first, if it meets no span taken
before it. The trees are trained on the driver, on EXAMPLES examples that fixed rules write (formats of personal data and of
look-alikes such as dates, prices, versions, quantities and order numbers), and travel as a broadcast of a few kilobytes.

Defined results: a null text is empty and has no spans; a text of any length is searched whole; of equal scores the candidate
that comes first is taken; repeated rows give repeated rows; extra columns are ignored; an empty table gives no rows. Spans
count code points, the end is exclusive.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from terrazzo.llm.common import utf8

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "ssn", "iban", "secret")
EXAMPLES, ROUNDS, DEPTH, RATE, BINS, PRECISION, GROUPS = 4000, 80, 4, 0.2, 32, 0.95, 6

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")  # a match always starts where a run of digits does
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) << (i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def emails(text: str) -> list[Span]:
    """An address is anchored at its @: the longest run of local characters before it, not into the match before."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append((start, m.end(), "email"))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str, at: bool = True, digit: bool = True, plus: bool = True) -> list[Span]:
    """By start, then kind. The flags tell whether the text has an @, a digit, a plus sign at all."""
    out = emails(text) if at else []
    if digit:
        out += [(*m.span(), "ip") for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 12 and 12 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
                out.append((*m.span(), "card"))
        if plus:
            out += [(*m.span(), "phone") for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


DIGITS = re.compile(r"(?<![A-Za-z0-9])[0-9]+(?![A-Za-z0-9])")
JOINT = re.compile(r"[ .\-/]|[ ]?[()][ -]?|\) ")
SPELLED = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:[\[(] ?at ?[\])]| at ) ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|[\[(] ?dot ?[\])]| dot ) ?[A-Za-z0-9-]{1,63})+")
IPV6 = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
TOKEN = re.compile(r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/=-]{16,256}(?![A-Za-z0-9_+/=-])")
NAMED = re.compile(r"""(?i)(?<![a-z])(?:pass(?:word|wd|phrase)?|pwd|secret|token|(?:api|access|private)[ _-]?key|bearer|credentials?)["']?(?: is| was)? ?[:=]? ?["']?([^\s"',;]{4,128})""")
NAMES = re.compile(r"(?i)pass|pwd|secret|token|key|bearer|credential")


def groups_of(text: str) -> Iterator[list[tuple[int, int]]]:
    """Runs of digit groups with nothing but one joint between neighbours."""
    run: list[tuple[int, int]] = []
    for m in DIGITS.finditer(text):
        if run and not (m.start() - run[-1][1] <= 3 and JOINT.fullmatch(text, run[-1][1], m.start())):
            yield run
            run = []
        run.append(m.span())
    if run:
        yield run


#: A candidate, and how many digit groups stand in its run before it, within it and after it.
Candidate = tuple[int, int, str, int, int, int]


def candidates(text: str, at: bool, digit: bool) -> list[Candidate]:
    out: list[Candidate] = []
    if digit:
        for run in groups_of(text):
            for i, (a, _) in enumerate(run):
                n = 0
                for j in range(i, min(len(run), i + GROUPS)):
                    n += run[j][1] - run[j][0]
                    if n > 19:
                        break
                    if n >= 7:
                        start = a - (a > 0 and text[a - 1] == "(" and ")" in text[a : run[j][1] + 1])
                        place = i, j - i + 1, len(run) - j - 1
                        out += [(start, run[j][1], kind, *place) for kind, ok in (("phone", n <= 15), ("card", n >= 12), ("ssn", n == 9 and j - i == 2)) if ok]
        out += [(*m.span(), "ip", 0, 0, 0) for m in IPV6.finditer(text)]
        out += [(*m.span(), "iban", 0, 0, 0) for m in IBAN.finditer(text)]
        out += [(*m.span(), "secret", 0, 0, 0) for m in TOKEN.finditer(text)]
    if at:
        out += [(*m.span(), "email", 0, 0, 0) for m in SPELLED.finditer(text)]
    if NAMES.search(text):
        out += [(*m.span(1), "secret", 0, 0, 0) for m in NAMED.finditer(text)]
    return sorted(set(out), key=lambda c: (c[0], c[1], KINDS.index(c[2])))


CUES = {
    "phone": re.compile(r"(?i)\b(tel|phone|call|fax|mobile|cell|contact|reach|dial|text|ring|whatsapp|sms)"),
    "card": re.compile(r"(?i)\b(card|visa|credit|debit|master|amex|paid|pay)"),
    "ssn": re.compile(r"(?i)\b(ssn|social|security)"),
    "email": re.compile(r"(?i)\b(mail|email|write|contact|address|reach)"),
    "iban": re.compile(r"(?i)\b(iban|account|bank|transfer|konto)"),
    "secret": re.compile(r"(?i)(pass|pwd|secret|token|key|bearer|credential)"),
    "ip": re.compile(r"(?i)\b(ip|host|server|address|ping|client)"),
}
MISLEADING = re.compile(r"(?i)\b(version|order|invoice|id|page|isbn|price|total|date|serial|ref|item|no|population|about|since|in|room|chapter|people|lot|batch|part)\b")
AFTER = re.compile(r"(?i)^\W{0,2}(people|units|items|dollars|euros|euro|usd|km|pages|inhabitants|copies|votes|times|percent|%|years|bytes)")


def features(text: str, c: Candidate) -> list[float]:
    a, b, kind, ahead, own_groups, behind = c
    own, before, after = text[a:b], text[max(0, a - 32) : a], text[b : b + 16]
    digits = digits_of(own)
    groups = [len(g) for g in re.findall("[0-9]+", own)] or [0]
    counts = Counter(own)
    entropy = -sum(n / len(own) * math.log2(n / len(own)) for n in counts.values())
    letters, upper = sum(ch.isalpha() for ch in own), sum(ch.isupper() for ch in own)
    flat = own.replace(" ", "")
    mod = kind == "iban" and int("".join(str(int(ch, 36)) for ch in flat[4:] + flat[:4])) % 97 == 1
    return [
        KINDS.index(kind), b - a, len(digits), len(groups), max(groups), min(groups), groups[0], groups[-1], groups[1] if len(groups) > 1 else 0,
        counts["."], counts["-"], counts[" "], counts["/"], "(" in own, counts[":"], ahead, own_groups, behind, letters, upper, entropy, len(counts), mod,
        luhn(digits) if digits else 0, digits[:1] == "0", all(ch in "0123456789abcdefABCDEF" for ch in own), before[-1:].isalnum() or before[-1:] in (".", "-", "$", "#", "€"),
        before[-1:] in ("+", "("), after[:1].isalnum() or after[:1] in ("-", "%"), bool(CUES[kind].search(before)), bool(MISLEADING.search(before)), bool(AFTER.search(after)), before[-2:].strip() in ("=", ":", "\"", "'"),
    ]


class Trees:
    """Logistic gradient boosting over quantile bins."""

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        binned = self._bin(x)
        score, self.trees = np.zeros(len(y)), []
        for _ in range(ROUNDS):
            p = 1 / (1 + np.exp(-score))
            g, h = p - y, p * (1 - p)
            node, tree = np.zeros(len(y), int), []
            for _ in range(DEPTH):
                splits = []
                for k in range(int(node.max()) + 1 if len(node) else 1):
                    splits.append(self._split(binned, g, h, node == k))
                tree.append(np.array(splits + [(0, BINS)] * (2 ** len(tree) - len(splits))))
                f, c = tree[-1][node].T
                node = 2 * node + (binned[np.arange(len(node)), f] > c)
            leaves = 2**DEPTH
            value = -np.bincount(node, g, leaves) / (np.bincount(node, h, leaves) + 1.0) * RATE
            self.trees.append((tree, value))
            score += value[node]
        return self

    def _split(self, binned: np.ndarray, g: np.ndarray, h: np.ndarray, own: np.ndarray) -> tuple[int, int]:
        best, at = 1e-6, (0, BINS)
        gs, hs = g[own].sum(), h[own].sum()
        for f in range(binned.shape[1]):
            gl = np.cumsum(np.bincount(binned[own, f], g[own], BINS + 1))[:-1]
            hl = np.cumsum(np.bincount(binned[own, f], h[own], BINS + 1))[:-1]
            gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)
            if gain.max() > best:
                best, at = gain.max(), (f, int(gain.argmax()))
        return at

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, v, "left") for c, v in zip(self.cuts, x.T, strict=True)], axis=1)

    def predict(self, x: np.ndarray) -> np.ndarray:
        binned, score = self._bin(x), np.zeros(len(x))
        for tree, value in self.trees:
            node = np.zeros(len(x), int)
            for level in tree:
                f, c = level[node].T
                node = 2 * node + (binned[np.arange(len(x)), f] > c)
            score += value[node]
        return 1 / (1 + np.exp(-score))


def formats(rng: random.Random, family: int) -> tuple[dict[str, list[str]], list[str]]:
    """Personal data by kind, and look-alikes; the two families share no format."""
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    w = lambda: "".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 8)))
    x = lambda n, of: "".join(rng.choice(of) for _ in range(n))
    hexes, mixed = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"

    def card(n: int) -> str:
        own = rng.choice("3456") + d(n - 1)
        while not luhn(own):
            own = own[:-1] + rng.choice("0123456789")
            own = own[0] + d(1) + own[2:]
        return own

    def iban(n: int) -> str:
        land, own = x(2, "ABCDEFGILMNPRST"), d(n)
        check = 98 - int("".join(str(int(ch, 36)) for ch in own + land + "00")) % 97
        return f"{land}{check:02}{own}"

    four = lambda s, by: by.join(s[i : i + 4] for i in range(0, len(s), 4))
    n = rng.choice([13, 15, 16, 16, 16, 19])
    if family:
        good = {
            "phone": [f"({d(3)}){d(3)}-{d(4)}", f"{d(3)} {d(3)} {d(4)}", f"0{d(4)} {d(6)}", f"{d(3)}-{d(4)}-{d(4)}", f"0{d(1)} {d(2)} {d(2)} {d(2)} {d(2)}", f"1-{d(3)}-{d(3)}-{d(4)}"],
            "card": [four(card(n), " ") + "", card(n)], "ssn": [f"{d(3)} {d(2)} {d(4)}"], "iban": [iban(16)],
            "email": [f"{w()}.{w()} at {w()} dot {rng.choice(['com', 'org'])}", f"{w()}{d(2)}[at]{w()}[dot]net"], "ip": [":".join(f"{rng.randrange(65536):04x}" for _ in range(8))],
            "secret": [x(32, hexes), "sk_" + x(28, mixed), x(rng.randint(8, 14), mixed + "!$%&*")],
        }
        bad = [f"{d(2)}-{d(2)}-{d(4)}", f"{d(1)} {d(3)} {d(3)}", f"{d(3)} {d(3)} {d(3)}", d(rng.randint(7, 14)), f"{d(4)}/{d(4)}", f"97{d(1)}-{d(1)}-{d(4)}-{d(4)}-{d(1)}", f"{d(2)}:{d(2)}:{d(2)}:{d(2)}", f"{w()}-{w()}-{w()}-{w()}", w() + w() + w() + w(), f"{d(4)} {d(4)} {d(4)} {d(4)}", f"{d(2)} {d(2)} {d(2)} {d(2)} {d(2)}"]
    else:
        good = {
            "phone": [f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"{d(3)}.{d(3)}.{d(4)}", f"0{d(2)} {d(4)} {d(4)}", f"0{d(3)} {d(6)}", f"{d(3)} {d(3)}-{d(4)}", f"1 {d(3)} {d(3)} {d(4)}", f"0{d(2)}/{d(7)}"],
            "card": [four(card(n), "-"), four(card(n), " "), card(n)], "ssn": [f"{d(3)}-{d(2)}-{d(4)}"], "iban": [four(iban(18), " "), iban(18), iban(20), four(iban(12), " ")],
            "email": [f"{w()}{rng.choice([' (at) ', '(at)', ' [at] '])}{w()}{rng.choice([' (dot) ', '.', '[dot]'])}{rng.choice(['com', 'org', 'net'])}", f"{w()}{d(1)} at {w()} dot {w()} dot org"], "ip": [":".join(f"{rng.randrange(65536):x}" for _ in range(8))],
            "secret": [x(40, hexes), x(64, hexes), "ghp_" + x(36, mixed), "AKIA" + x(16, mixed.upper()), x(rng.randint(20, 44), mixed), w() + d(rng.randint(2, 4)) + rng.choice("!#$%"), x(rng.randint(9, 16), mixed)],
        }
        bad = [f"{d(4)}-{d(2)}-{d(2)}", f"{d(2)}/{d(2)}/{d(4)}", d(rng.randint(7, 15)), f"{d(1)}.{d(2)}.{d(3)}.{d(2)}", f"{d(3)} {d(3)} {d(3)}", f"{d(2)} {d(3)} {d(3)}", f"{d(3)}.{d(3)}.{d(3)}.{d(2)}", f"{d(4)}-{d(4)}", f"{d(rng.randint(4, 9))}.{d(2)}", " ".join(d(rng.randint(1, 2)) for _ in range(8)), four(d(16), " "), f"978-{d(1)}-{d(5)}-{d(3)}-{d(1)}", f"{d(4)}-{d(2)}-{d(2)} {d(2)}", d(16), f"{w()} at {w()}. {w().capitalize()}", f"{w()}_{w()}_{w()}_{w()}", w() + w() + w() + w(), ":".join(d(2) for _ in range(4)), f"{x(2, 'ABCDE')}{d(2)} {d(4)} {d(4)}", f"{w()}-{w()}-{w()}-{d(4)}", ":".join(x(2, hexes) for _ in range(6)), f"{d(3)}-{d(2)}-{d(2)}", f"the secret is {w()}", f"password {w()}", f"978-{d(1)}-{d(2)}-{d(6)}-{d(1)}", f"{d(2)}.{d(4)} {d(1)}.{d(4)}"]
    return good, bad


CONTEXT = {"phone": ["tel", "phone", "call", "fax", "mobile", "text me on"], "card": ["card", "visa", "credit card", "paid with"], "ssn": ["ssn", "social security"], "email": ["mail", "write to", "contact"], "ip": ["host", "server"], "iban": ["iban", "account"], "secret": ["password:", "token =", "api_key=", "the secret is", 'token = "']}
DISTRACT = ["version", "order", "invoice", "date", "serial", "no", "about", "population", "total", "isbn", "page", "room"]


def example(rng: random.Random, family: int) -> tuple[str, set[Span]]:
    """A text, and its personal data."""
    w = lambda: "".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 8)))
    text, found = " ".join(w() for _ in range(rng.randint(1, 4))), set()
    for _ in range(rng.randint(1, 3)):
        good, bad = formats(rng, family)
        if rng.random() < 0.5:
            kind = rng.choice(list(good))
            own = rng.choice(good[kind])
            plain = kind == "secret" and len(own) < 20 or kind == "ssn" and " " in own  # nothing but the words before tells these
            cue = rng.choice(CONTEXT[kind]) if plain or rng.random() < 0.5 else w()
            text += f" {cue}" + ("" if cue[-1] in '="' else " ")
            found.add((len(text), len(text) + len(own), kind))
            text += own + ('"' if cue[-1] == '"' else "")
            if kind == "phone" and rng.random() < 0.3:
                again = re.sub("[0-9]", lambda m: rng.choice("0123456789"), own)
                text += " "
                found.add((len(text), len(text) + len(again), kind))
                text += again
            elif rng.random() < 0.15:
                text += f" {rng.randint(1, 99)} {rng.choice(['items', 'times', w(), w()])}"
        else:
            text += f" {rng.choice(DISTRACT) if rng.random() < 0.5 else w()} {rng.choice(bad)}{' ' + rng.choice(['people', 'units', 'items']) if rng.random() < 0.2 else ''}"
        text += " " + " ".join(w() for _ in range(rng.randint(1, 3)))
    return text, found


def examples(seed: int, family: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and truth of the candidates of n texts; base spans are not the trees' business."""
    rng, x, y = random.Random(seed), [], []
    for _ in range(n):
        text, found = example(rng, family)
        for c in candidates(text, True, True):
            x.append(features(text, c))
            y.append(c[:3] in found)
    return np.array(x, float), np.array(y, float)


class Model:
    """Trees of one family of formats; calibration (a logistic curve) and thresholds by the other."""

    def __init__(self, seed: int = 7):
        self.trees = Trees().fit(*examples(seed, 0, EXAMPLES))
        x, y = examples(seed + 1, 1, EXAMPLES // 2)
        margin = self.margin(x)
        self.slope, self.shift = 1.0, 0.0
        for _ in range(50):  # Newton's method
            p = 1 / (1 + np.exp(-(self.slope * margin + self.shift)))
            g = np.array([((p - y) * margin).sum(), (p - y).sum()])
            v = p * (1 - p) + 1e-9
            h = np.array([[(v * margin**2).sum(), (v * margin).sum()], [(v * margin).sum(), v.sum()]])
            step = np.linalg.solve(h + np.eye(2) * 1e-3, g)
            self.slope, self.shift = self.slope - step[0], self.shift - step[1]
        p = self.predict(x)
        self.least = {}
        for k, kind in enumerate(KINDS):
            own = x[:, 0] == k
            order = np.argsort(-p[own], kind="stable")
            good = np.cumsum(y[own][order]) / np.arange(1, own.sum() + 1)
            enough = np.flatnonzero(good >= PRECISION)
            self.least[kind] = max(0.5, float(p[own][order][enough[-1]])) if len(enough) else 2.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        p = self.trees.predict(x).clip(1e-9, 1 - 1e-9)
        return np.log(p / (1 - p))

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * self.margin(x) + self.shift)))

    def spans(self, text: str, at: bool = True, digit: bool = True, plus: bool = True) -> tuple[list[Span], list[Span]]:
        """Base spans, and all spans; both by start, then kind."""
        base = base_spans(text, "@" in text, digit, plus) if at or digit else []
        found = candidates(text, at, digit)
        if not found:
            return base, base
        p = self.predict(np.array([features(text, s) for s in found], float))
        every, taken = list(base), Taken()
        for a, b, _ in base:
            taken.add(a, b)
        for i in np.argsort(-p, kind="stable"):
            a, b, kind = found[i][:3]
            if p[i] >= self.least[kind] and taken.free(a, b):
                every.append((a, b, kind))
                taken.add(a, b)
        return base, sorted(every, key=lambda s: (s[0], KINDS.index(s[2])))


class Taken:
    """Stretches of text that spans cover; kept apart, in order."""

    def __init__(self):
        self.starts: list[int] = []
        self.ends: list[int] = []

    def free(self, a: int, b: int) -> bool:
        i = bisect.bisect_right(self.starts, a)
        return (not i or self.ends[i - 1] <= a) and (i == len(self.starts) or self.starts[i] >= b)

    def add(self, a: int, b: int) -> None:
        i = bisect.bisect_left(self.starts, a)
        lo, hi = i, i
        if i and self.ends[i - 1] >= a:
            lo = i - 1
            a, b = self.starts[lo], max(b, self.ends[lo])
        while hi < len(self.starts) and self.starts[hi] <= b:
            b = max(b, self.ends[hi])
            hi += 1
        self.starts[lo:hi], self.ends[lo:hi] = [a], [b]


def show(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def redact(text: str, spans: list[Span]) -> str:
    """Each span, or run of overlapping spans, replaced by its first kind in angle brackets."""
    out, upto = [], 0
    for a, b, kind in spans:
        if a >= upto:
            out += [text[upto:a], f"<{kind}>"]
        upto = max(upto, b)
    return "".join([*out, text[upto:]])


_MODELS: dict[int, Model] = {}


def find(documents: DataFrame, keep_text: bool = True, seed: int = 7) -> DataFrame:
    """doc_id, n_<kind> of the base spans, base_sha256, spans, n_spans, and the redacted text if keep_text."""
    if seed not in _MODELS:
        _MODELS[seed] = Model(seed)
    shared = documents.sparkSession.sparkContext.broadcast(_MODELS[seed])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            column = batch.column("text")
            data, offsets = utf8(column)
            has = lambda mask: np.diff(np.searchsorted(np.flatnonzero(mask), offsets)) > 0
            own = data[: offsets[-1]]
            spelled = pc.fill_null(pc.match_substring_regex(column, r"@|[\[(] ?at ?[\])]| at [A-Za-z0-9-]+( dot |\.)"), False).to_numpy(zero_copy_only=False)
            flags = zip(spelled, has((own >= 0x30) & (own <= 0x39)), has(own == 0x2B), strict=True)
            rows = []
            for i, (at, digit, plus) in enumerate(flags):
                text = column[i].as_py() or ""
                base, every = model.spans(text, bool(at), bool(digit), bool(plus))
                rows.append((*(sum(s[2] == k for s in base) for k in BASE), hashlib.sha256(show(base).encode()).hexdigest(), show(every), len(every), *[redact(text, every)] * keep_text))
            names = [*(f"n_{k}" for k in BASE), "base_sha256", "spans", "n_spans", *["redacted"] * keep_text]
            kinds = [*[pa.int64()] * 4, *[pa.string()] * 2, pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array([r[j] for r in rows], kinds[j]) for j in range(len(names)))], ["doc_id", *names])

    kind = documents.schema["doc_id"].dataType.simpleString()
    redacted = ", redacted string" if keep_text else ""
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_spans bigint{redacted}")
