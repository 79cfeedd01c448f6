"""Operator 5: personal data, by gradient-boosted trees over candidate spans.

Four base kinds are exact rules. Beyond them, high-recall generators propose overlapping spans
(keys and tokens, written-out mail addresses, national phone, account and identity numbers in the shapes of
the corpus's languages); boosted trees score each by its form and by the words around it; a
threshold for each kind, calibrated for precision on held-out examples, selects; of overlapping
selected spans the best stays. Spans that touch a base span are dropped, base spans never are.

The trees are trained on the driver on ``examples`` seeded spans, personal ones and look-alikes, that are
planted into prose of the corpus (``prose``: at most ``texts`` stretches of ``chars`` characters at hashed
places); look-alikes besides are what the generators find in that prose where nothing was planted.
Detection runs in the tasks on whole texts, without a shuffle, in time linear in a text's length.
"""

from __future__ import annotations

import bisect
import hashlib
import random
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("secret", "written_email", "local_phone", "iban", "national_id")
KINDS = (*BASE_KINDS, *ADDED_KINDS)
ORDER = {k: i for i, k in enumerate(KINDS)}

# The rules of the base kinds. Runs are taken whole and never tried again from their middle, where
# that changes no match: a long text costs one pass.
EMAIL_HOST = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
LOCAL_CHARS = frozenset(LETTERS + "0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the exact rules; leftmost and non-overlapping for each kind."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:  # a mail address starts where the run of its local characters does
        a = at
        while a > last and text[a - 1] in LOCAL_CHARS:
            a -= 1
        m = EMAIL_HOST.match(text, at) if a < at else None
        if m:
            out.append((a, m.end(), "email"))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    for m in IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (p.lstrip("0") for p in m[0].split("."))):
            out.append((m.start(), m.end(), "ip"))
    for m in CARD.finditer(text):
        if 12 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
            out.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(digits_of(m[0])) <= 15:
                out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda s: (s[0], ORDER[s[2]]))


class Intervals:
    """Spans (start, end, kind), and a search for any that a stretch touches, by their sorted union."""

    def __init__(self, spans: Sequence[tuple[int, int, str]] = ()):
        self.spans, self.starts, self.ends = list(spans), [], []
        for a, b, _ in sorted(spans):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def touches(self, a: int, b: int) -> bool:
        k = bisect.bisect_left(self.starts, b) - 1  # the last stretch that starts before b
        return k >= 0 and self.ends[k] > a

    def add(self, span: tuple[int, int, str]) -> None:
        """A span that touches none."""
        k = bisect.bisect_left(self.starts, span[0])
        self.spans.append(span)
        self.starts.insert(k, span[0])
        self.ends.insert(k, span[1])


# --- candidates ---

_OPEN, _CLOSE = r"(?: ?[\[(] ?| )", r"(?: ?[\])] ?| )"
GENERATORS = {
    "secret": re.compile(r"(?<![A-Za-z0-9_/+-])(?=[A-Za-z_/+-]*+[0-9])[A-Za-z0-9_/+-]{14,}+"),
    "written_email": re.compile(rf"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{{2,64}}+{_OPEN}(?:at|AT){_CLOSE}[A-Za-z0-9-]{{2,63}}+(?:{_OPEN}(?:dot|DOT){_CLOSE}[A-Za-z0-9-]{{2,63}}+)+"),
    "local_phone": re.compile(
        r"(?<![0-9A-Za-z+])(?:\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}([ .-])[0-9]{3}[ .-][0-9]{4}"  # three, three, four
        r"|0[1-9](?:[ .-]?[0-9]{2}){4}|0[1-9][0-9]{1,4}[ /-][0-9]{5,8}|[6-9][0-9]{2}(?: [0-9]{2}){3}|[6-9][0-9]{2}(?:[ -][0-9]{3}){2})(?![0-9A-Za-z])"  # pairs; area and number; nine digits
    ),
    "iban": re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b"),
    "national_id": re.compile(
        r"(?<![0-9A-Za-z])(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|[0-9]{8}-?[A-Z]|[XYZ]-?[0-9]{7}-?[A-Z]"  # three, two, four; digits and a letter
        r"|[12] ?[0-9]{2} ?(?:0[1-9]|1[0-2]) ?[0-9]{2} ?[0-9]{3} ?[0-9]{3} ?[0-9]{2}|[0-9]{2} [0-9]{3} [0-9]{3} [0-9]{3})(?![0-9A-Za-z])"  # fifteen digits; eleven
    ),
}
WORDS_AROUND = (
    ("token", "secret", "api", "key", "pass", "pwd", "auth", "credential", "bearer", "clave", "passwort", "mot de passe"),
    ("phone", "tel", "call", "mobile", "fax", "contact", "tél", "appel", "llama", "móvil", "anruf", "mobil"),
    ("ssn", "social", "tax", "insurance", "id", "dni", "nie", "nir", "steuer", "sécurité"),
    ("iban", "account", "bank", "transfer", "payee", "konto", "compte", "cuenta"),
    ("mail", "write", "reach", "contact", "correo", "courriel", "schreib"),
    ("version", "isbn", "order", "invoice", "part", "sku", "page", "date", "build", "chapter", "http", "www", "file", "rechnung", "facture",
    "pedido"),
)
#: How far around a span its context is read.
REACH = 32
#: The check letters of identity numbers of eight digits, by the number modulo 23. Fixed value.
CHECK_LETTERS = "TRWAGMYFPDXBNJZSQVHLCKE"


def candidates(text: str) -> list[tuple[int, int, str]]:
    out = []
    for kind, pattern in GENERATORS.items():
        if kind == "written_email" and not ("dot" in text or "DOT" in text):
            continue
        out += [(m.start(), m.end(), kind) for m in pattern.finditer(text)]
    return out


def mod97(s: str) -> bool:
    s = s.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def checked(s: str) -> float:
    """Whether an identity number has the check letter or key of its shape; -1 for shapes without one."""
    s = s.replace(" ", "").replace("-", "")
    if s[-1].isalpha():
        return float(CHECK_LETTERS[int(s[:-1].replace("X", "0").replace("Y", "1").replace("Z", "2")) % 23] == s[-1])
    if len(s) == 15:
        return float(97 - int(s[:13]) % 97 == int(s[13:]))
    return -1.0 if len(s) > 9 else float(s[:3] not in ("000", "666") and s[0] != "9" and s[3:5] != "00" and s[5:] != "0000")


def features(text: str, start: int, end: int, kind: str) -> list[float]:
    s = text[start:end]
    before, after = text[max(0, start - REACH) : start], text[end : end + REACH]
    n, near = len(s), before.lower()
    digit, upper, lower = (sum(f(c) for c in s) for f in (str.isdigit, str.isupper, str.islower))
    counts = np.array(list(Counter(s).values())) / n
    switches = sum(a.isdigit() != b.isdigit() for a, b in zip(s, s[1:], strict=False))
    return [
        float(ADDED_KINDS.index(kind)), float(n), digit / n, upper / n, lower / n,
        float(-(counts * np.log2(counts)).sum()), switches / n,
        sum(c in "0123456789abcdef" for c in s) / n, float(s.isupper()), sum(not c.isalnum() for c in s) / n,
        float(bool(re.search(r"[=:]\s*[\"']?$", before))), float(before[-1:] in "\"'") + float(after[:1] in "\"'"),
        float(luhn(d)) if (d := digits_of(s)) else -1.0, float(len(d)),
        float(mod97(s)) if kind == "iban" else -1.0, checked(s) if kind == "national_id" else -1.0, float(s[:1] == "("), float("(" in s or "[" in s),
        float(max((len(w) for w in re.findall(r"[A-Za-z]+", s)), default=0)), float(n - len(s.rstrip(LETTERS))), float(" " in s),
        float(before[-1:].isalnum() or before[-1:] in tuple("./-_")), float(after[:1].isalnum() or after[:1] in tuple("/-_")),
        *(float(any(w in near for w in words)) for words in WORDS_AROUND),
    ]


# --- boosted trees ---


class BoostedTrees:
    """Logistic gradient boosting over depth-limited regression trees on binned features."""

    def __init__(self, rounds: int = 100, depth: int = 3, rate: float = 0.2, bins: int = 24):
        self.rounds, self.depth, self.rate, self.bins = rounds, depth, rate, bins

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        self.cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(self.cuts)], 1)
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start, self.trees = float(np.log(share / (1 - share))), []
        f = np.full(len(y), self.start)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-f))
            tree = self.grow(binned, y - p, p * (1 - p), np.arange(len(y)), self.depth)
            self.trees.append(tree)
            f += self.walk(tree, x)
        return self

    def grow(self, binned, g, h, rows, depth):
        leaf = float(self.rate * g[rows].sum() / (h[rows].sum() + 1.0))
        if not depth or len(rows) < 20:
            return leaf
        best = (1e-6, None)
        total_g, total_h = g[rows].sum(), h[rows].sum()
        for j, cuts in enumerate(self.cuts):
            if not len(cuts):
                continue
            b = binned[rows, j]
            gl = np.cumsum(np.bincount(b, g[rows], len(cuts) + 1))[:-1]
            hl = np.cumsum(np.bincount(b, h[rows], len(cuts) + 1))[:-1]
            gain = gl**2 / (hl + 1) + (total_g - gl) ** 2 / (total_h - hl + 1) - total_g**2 / (total_h + 1)
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (gain[k], (j, k))
        if best[1] is None:
            return leaf
        j, k = best[1]
        left = binned[rows, j] <= k
        return (j, float(self.cuts[j][k]), self.grow(binned, g, h, rows[left], depth - 1), self.grow(binned, g, h, rows[~left], depth - 1))

    def walk(self, tree, x: np.ndarray) -> np.ndarray:
        if not isinstance(tree, tuple):
            return np.full(len(x), tree)
        j, cut, low, high = tree
        return np.where(x[:, j] <= cut, self.walk(low, x), self.walk(high, x))

    def probability(self, x: np.ndarray) -> np.ndarray:
        f = np.full(len(x), self.start)
        for t in self.trees:
            f += self.walk(t, x)
        return 1 / (1 + np.exp(-f))


def made_examples(n: int, seed: int, prose: Sequence[str] = ()) -> tuple[list[tuple[str, int, int, str]], np.ndarray]:
    """Seeded spans in context, personal or not: (text, start, end, kind) and labels.

    They are planted between words of ``prose`` where there is any, else between made words. What the
    generators find in the prose itself, apart from anything planted, are look-alikes, too, where no word of
    the kind's list stands before it.
    """
    r = random.Random(seed)
    hexes, mixed, upper = "0123456789abcdef", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    pick = lambda chars, k: "".join(r.choice(chars) for _ in range(k))
    word = lambda: pick("aeiourstlnmdk", r.randint(2, 9))
    number = lambda k: pick("0123456789", k)

    def iban() -> str:
        body = number(r.choice((14, 18, 16)))
        country = r.choice(("DE", "FR", "GB", "ES"))
        check = 98 - int("".join(str(int(c, 36)) for c in body + country + "00")) % 97
        s = f"{country}{check:02d}{body}"
        return " ".join(s[i : i + 4] for i in range(0, len(s), 4)) if r.random() < 0.5 else s

    def local_phone() -> str:
        pair, sep = (lambda: number(2)), r.choice((" ", ".", "-", ""))
        return r.choice((
            f"({number(3)}) {number(3)}-{number(4)}", f"{number(3)}-{number(3)}-{number(4)}", f"{number(3)}.{number(3)}.{number(4)}",
            f"0{r.randint(1, 9)}{sep}" + sep.join(pair() for _ in range(4)),
            f"0{r.randint(1, 9)}{number(r.randint(1, 3))}{r.choice(' /-')}{number(r.randint(6, 8))}",
            f"{r.choice('679')}{number(2)} {pair()} {pair()} {pair()}", f"{r.choice('679')}{number(2)} {number(3)} {number(3)}",
        ))

    def national_id() -> str:
        eight, seven = number(8), number(7)
        thirteen = f"{r.choice('12')}{number(2)}{r.randint(1, 12):02d}{number(8)}"
        key = f"{97 - int(thirteen) % 97:02d}"
        first = r.choice("XYZ")
        return r.choice((
            f"{r.randint(1, 665):03d}-{r.randint(1, 99):02d}-{r.randint(1, 9999):04d}",
            f"{eight}{r.choice(('', '-'))}{CHECK_LETTERS[int(eight) % 23]}",
            f"{first}{seven}{CHECK_LETTERS[int(str('XYZ'.index(first)) + seven) % 23]}", thirteen + key,
            " ".join((thirteen[:1], thirteen[1:3], thirteen[3:5], thirteen[5:7], thirteen[7:10], thirteen[10:], key)),
            f"{number(2)} {number(3)} {number(3)} {number(3)}",
        ))

    spell = lambda name: r.choice((f" {name} ", f" [{name}] ", f" ({name}) ", f" {name.upper()} ", f"[{name}]", f"({name})"))
    personal = {
        "secret": lambda: r.choice((
            lambda: (f'{r.choice(("token", "secret", "api_key", "key", "password", "auth"))} {r.choice("=:")} "', pick(hexes, r.choice((32, 40, 64))),
            '"'),
            lambda: (f'{r.choice(("key", "token", "secret", "apikey"))}=', pick(mixed + "_-", r.randint(20, 48)), " "),
            lambda: (f'{r.choice(("password", "passwd", "pwd", "secret", "token"))}{r.choice(("=", ": "))}',
            pick(r.choice((hexes, mixed)), r.randint(14, 28)) + "7", r.choice((" ", ".", "\n"))),
            lambda: (f'{r.choice(("token", "key", "bearer"))} ', pick(mixed + "_-", r.randint(120, 900)), r.choice((" ", ".", "\n"))),
            lambda: (" ", r.choice(("AKIA", "ASIA")) + pick(upper, 16), " "),
            lambda: (" ", r.choice(("ghp_", "sk_live_", "xoxb-", "AIza")) + pick(mixed, r.randint(24, 40)), " "),
            lambda: (" ", pick(hexes, r.choice((32, 40, 64))), " "),
        ))(),
        "written_email": lambda: (r.choice((" ", "write to ", "mail ")),
        f"{word()}{r.choice(('', '.' + word(), number(2)))}{spell('at')}{word()}{''.join(spell('dot') + x for x in ([word()] if r.random() < 0.2 else []))}{spell('dot')}{r.choice(('com', 'org', 'net', 'de', 'fr', 'es'))}",
        " "),
        "local_phone": lambda: (r.choice((" call ", " phone: ", " tel ", " tél. ", " mobile ", " móvil ", " ")), local_phone(), " "),
        "iban": lambda: (r.choice((" iban ", " account ", " konto ", " ")), iban(), " "),
        "national_id": lambda: (r.choice((" ssn ", " social security ", " dni ", " steuer-id ", " nir ", " id ")), national_id(), " "),
    }
    other = {
        "secret": lambda: r.choice((
            lambda: (" ", f"{word()}-{word()}-{number(r.randint(1, 4))}", " "),
            lambda: (" http:/", f"/{word()}/{word()}/{number(3)}", " "),
            lambda: (" ", f"{word()}_{word()}_{word()}{number(1)}", "."),
            lambda: (" version ", f"{number(1)}-{word()}-build{number(3)}", " "),
            lambda: (" ", number(r.choice((r.randint(14, 20), r.randint(20, 400)))), " "),
            lambda: (" ", f"{r.choice(('19', '20'))}{number(2)}-{number(2)}-{number(2)}-{number(4)}", " "),
            lambda: (" ", word() * 3 + number(1), " "),
        ))(),
        "written_email": lambda: (" ", f"{word()} at {word()} dot {word()[:8]}ing", " "),
        "local_phone": lambda: (r.choice((" order ", " invoice ", " part ", " isbn ", " rechnung ", " facture ", " pedido ")),
        r.choice((f"{number(3)} {number(3)} {number(4)}", local_phone())), " "),
        "iban": lambda: (r.choice((" sku ", " part ", " ")), f"{pick('ABCDEFGH', 2)}{number(2)}{pick(upper, 4)}{pick(upper, 4)}{pick(upper, 4)}",
        " "),
        "national_id": lambda: r.choice((
            lambda: (r.choice((" part ", " page ", " order ", " sku ")), r.choice((f"{number(3)}-{number(2)}-{number(4)}",
            f"{number(2)} {number(3)} {number(3)} {number(3)}")), " "),
            lambda: (r.choice((" part ", " order ", " ")), r.choice((f"{number(8)}{r.choice('ABCDEFGH')}",
            r.choice("12") + number(2) + "07" + number(10))), " "),
        ))(),
    }
    prose = [x for x in prose if " " in x.strip()]

    def around() -> tuple[str, str]:
        if not prose:
            return " ".join(word() for _ in range(r.randint(0, 6))), word()
        text = r.choice(prose)
        at = text.find(" ", r.randrange(len(text)))
        return (text[max(0, at - 2 * REACH) : at], text[at : at + REACH]) if at >= 0 else (text[-2 * REACH :], "")

    rows, labels = [], []
    for i in range(n):
        kind = ("secret", *ADDED_KINDS)[i // 2 % (len(ADDED_KINDS) + 1)]  # secrets have the most forms
        label = i % 2
        for _ in range(8):
            before, s, after = (personal if label else other)[kind]()
            if GENERATORS[kind].fullmatch(s):  # else it would never be a candidate of the kind
                break
        head, tail = around()
        head += before
        rows.append((head + s + after + tail, len(head), len(head) + len(s), kind))
        labels.append(label)
    for text in prose:
        base = Intervals(base_spans(text))
        for a, b, kind in candidates(text):
            before = text[max(0, a - REACH) : a].lower()
            if not base.touches(a, b) and not any(w in before for words in WORDS_AROUND[:5] for w in words):
                rows.append((text[max(0, a - 2 * REACH) : b + REACH], min(a, 2 * REACH), min(a, 2 * REACH) + b - a, kind))
                labels.append(0)
    return rows, np.array(labels, float)


def prose(documents: DataFrame, texts: int = 400, chars: int = 1000, seed: int = 11) -> list[str]:
    """At most ``texts`` stretches of ``chars`` characters of ``documents``, chosen and placed by a hash of the id; for training only."""
    at = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.greatest(F.length("text") - chars, F.lit(0)) + 1).cast("int") + 1
    rows = documents.select("doc_id", F.xxhash64("text").alias("h"), F.substring(F.col("text"), at, F.lit(chars)).alias("part"))
    return [r.part for r in shared.drawn(rows, texts, seed, "doc_id", "h").collect() if r.part]


def held_out(kinds: np.ndarray, labels: np.ndarray, seed: int) -> np.ndarray:
    """A seeded quarter of the spans of each kind and label."""
    out, order = np.zeros(len(labels), bool), np.random.default_rng(seed).permutation(len(labels))
    for kind in ADDED_KINDS:
        for label in (0, 1):
            own = order[(kinds[order] == kind) & (labels[order] == label)]
            out[own[: len(own) // 4]] = True
    return out


class Detector:
    """Trained trees and a threshold for each added kind."""

    def __init__(self, prose: Sequence[str] = (), examples: int = 6000, precision: float = 0.98, seed: int = 11):
        rows, y = made_examples(examples, seed, prose)
        x = np.array([features(*r) for r in rows])
        kinds = np.array([r[3] for r in rows])
        held = held_out(kinds, y, seed)
        for kind in ADDED_KINDS:  # without both labels in both parts, a kind is not learnt or its precision not tested
            for part in (held, ~held):
                if len(np.unique(y[part & (kinds == kind)])) < 2:
                    raise ValueError(f"{examples} examples do not give {kind} both labels in training and held-out spans")
        self.trees = BoostedTrees().fit(x[~held], y[~held])
        p = self.trees.probability(x[held])
        self.threshold = {}
        for kind in ADDED_KINDS:  # the least threshold with that precision on held-out spans, and never under 0.6
            own = kinds[held] == kind
            order = np.argsort(-p[own], kind="stable")
            ranked = p[own][order]
            right = np.cumsum(y[held][own][order]) / np.arange(1, own.sum() + 1)
            last = np.append(ranked[1:] < ranked[:-1], True)  # a threshold takes all spans of equal probability
            good = np.flatnonzero((right >= precision) & last)
            self.threshold[kind] = max(0.6, float(ranked[good[-1]])) if len(good) else 2.0

    def spans(self, text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
        """Base spans, and all spans in order."""
        base = base_spans(text)
        taken = Intervals(base)
        found = [c for c in candidates(text) if not taken.touches(c[0], c[1])]
        chosen = Intervals()
        if found:
            p = np.concatenate([self.trees.probability(np.array([features(text, *c) for c in found[i : i + 4096]])) for i in range(0, len(found),
                4096)])
            for q, c in sorted(zip(p.tolist(), found, strict=True), key=lambda z: (-z[0], z[1])):
                if q >= self.threshold[c[2]] and not chosen.touches(c[0], c[1]):
                    chosen.add(c)
        return base, sorted(base + chosen.spans, key=lambda s: (s[0], ORDER[s[2]]))


#: Bytes without which no generator and no rule finds anything, but for written-out addresses.
TELLING = np.zeros(256, bool)
TELLING[list(b"0123456789@")] = True


def to_examine(column: pa.Array) -> np.ndarray:
    """Rows in which anything can be found at all."""
    data, offsets = shared.utf8(column)
    hit = np.concatenate([[0], np.cumsum(TELLING[data])])
    out = hit[offsets[1:]] > hit[offsets[:-1]]
    return out | pc.match_substring(column.fill_null(""), "dot", ignore_case=True).to_numpy(zero_copy_only=False)


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def personal_data(documents: DataFrame, detector: Detector | None = None) -> DataFrame:
    """Per row of ``documents``: counts of base spans, base_sha256, and all spans.

    Null and empty texts have no spans (the hash is that of no text); repeated rows get equal
    results; an empty table gives an empty result; other columns are ignored. Of overlapping candidates with
    equal probabilities the one that starts first stays. A very long text is examined whole, in time
    linear in its length. Offsets are code points, ends exclusive.
    """
    detector = detector or Detector(prose(documents))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = hashlib.sha256(b"").hexdigest()
        for b in batches:
            text, n = b.column(1), b.num_rows
            counts, hashes, spans = np.zeros((4, n), np.int64), [nothing] * n, [""] * n
            for i in np.flatnonzero(to_examine(text)).tolist():
                base, every = detector.spans(text[i].as_py())
                for _, _, k in base:
                    counts[ORDER[k], i] += 1
                hashes[i], spans[i] = hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, counts), pa.array(hashes, pa.string()), pa.array(spans, pa.string())],
                ["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run,
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    """Each stretch of overlapping spans becomes the mark of its first kind."""
    out, at, i = [], 0, 0
    while i < len(spans):
        a, b, kind = spans[i]
        i += 1
        while i < len(spans) and spans[i][0] < b:
            b, i = max(b, spans[i][1]), i + 1
        out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def redacted(documents: DataFrame, detector: Detector | None = None) -> DataFrame:
    """``documents`` with personal data replaced by marks, and n_chars, if there, set anew. Null texts stay null."""
    detector = detector or Detector(prose(documents))
    names = documents.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k = names.index("text")
            text = b.column(k)
            examine = to_examine(text)
            if examine.any():
                new = text.to_pylist()
                for i in np.flatnonzero(examine).tolist():
                    if new[i] is not None:
                        new[i] = redact(new[i], detector.spans(new[i])[1])
                b = b.set_column(k, b.schema.field(k), pa.array(new, text.type))
            yield b

    out = documents.mapInArrow(run, documents.schema)
    return out.withColumn("n_chars", F.when(F.col("text").isNull(),
        F.col("n_chars")).otherwise(F.length("text").cast(documents.schema["n_chars"].dataType))) if "n_chars" in names else out


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(shared.table(spark, sf_dir, "documents"))
