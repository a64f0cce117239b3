"""Personal data by a semi-Markov conditional random field beside exact base patterns (operator 9).

The field scores whole segments: a window of text is cut into atoms (runs of digits, runs of letters, single
other characters), every segment of up to ``MAX_ATOMS`` atoms or ``MAX_DIGITS`` digits that could be an entity becomes a typed candidate
with features of the entire span, and dynamic programming over segment ends picks the best joint choice of
boundaries and types. Weights are fitted here by gradient ascent on the conditional likelihood of generated
sentences. Only windows that hold a digit or an ``@`` are decoded: without one no candidate exists and the best
segmentation has no entity, so skipping them changes nothing.

Base matches always stay; the field adds entities that overlap none of them, such as a card number that the base
pattern drops because it ran into the digits before it.
"""

from __future__ import annotations

import functools
import hashlib
import math
import random
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import map_texts, small_batches

KINDS = ("email", "ip", "card", "phone")
MAX_ATOMS, MAX_DIGITS = 24, 19
TRAIN_SENTENCES, EPOCHS, RATE, DECAY = 1500, 6, 0.3, 1e-5

# --- base patterns -----------------------------------------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _part(s: str) -> bool:
    s = s.lstrip("0")
    return len(s) < 3 or len(s) == 3 and s <= "255"


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of local@domain, found from their ``@`` so that long runs of local characters cost one look each."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        last = m.end() if m else at + 1
        at = text.find("@", last)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base matches, in order."""
    out = [(a, 0, b) for a, b in _emails(text)]
    if "." in text:
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(map(_part, m.group().split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := _NOT_DIGIT.sub("", m.group())) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]
    return sorted(out)


# --- the field ---------------------------------------------------------------------------------------------

_ATOM = re.compile(r"[0-9]+|[^\W\d_]+|.", re.S)
_TRIGGER = re.compile(r"[0-9@]")
_WINDOW = re.compile(r"[+(]?[^\s]+(?:\x20(?=[^\s]*[0-9@])[^\s]+)*")
_WHOLE = {
    0: re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
    1: re.compile(r"[0-9]+(?:\.[0-9]+){3}"),
    2: re.compile(r"[0-9](?:[\x20-]?[0-9])+"),
    3: re.compile(r"\+?\(?[0-9][\x20().0-9-]+[0-9]"),
}
_US = re.compile(r"(?:\+?1[\x20.-]?)?(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}")


def windows(text: str) -> Iterator[tuple[int, int]]:
    """Runs of space-parted words that each hold a digit or an ``@``."""
    at, n = 0, len(text)
    while m := _TRIGGER.search(text, at):
        a = m.start()
        while a > at and not text[a - 1].isspace():
            a -= 1
        b = _WINDOW.match(text, a).end()
        yield a, b
        at = min(b, n)


def features(kind: int, span: str, left: str, right: str) -> list[str]:
    """Names of the features of a whole segment as ``kind``."""
    digits = _NOT_DIGIT.sub("", span)
    out = [f"{kind}:bias"]
    if kind == 0:
        out.append(f"0:tld{min(len(span.rpartition('.')[2]), 5)}")
        out.append(f"0:alpha_tld{span.rpartition('.')[2].isalpha()}")
        out.append(f"0:edge{left in _LOCAL and left != ''}{right.isalnum()}")
    elif kind == 1:
        out.append(f"1:parts{all(map(_part, span.split('.')))}")
        out.append(f"1:edge{left == '.'}{right.isalnum() or right == '-'}")
    elif kind == 2:
        groups = re.split(r"[\x20-]", span)
        out.append(f"2:luhn{luhn(digits)}")
        out.append(f"2:n{len(digits)}")
        out.append(f"2:even{len({len(g) for g in groups[:-1]}) <= 1}")
        out.append(f"2:one_group{len(groups) == 1}")
        out.append(f"2:major{digits[0] in '3456'}")
        out.append(f"2:edge{left.isalnum() or left in ('.', '+') and left != ''}{right.isalpha()}")
    else:
        out.append(f"3:plus{span[0] == '+'}")
        out.append(f"3:us{_US.fullmatch(span) is not None}")
        out.append(f"3:n{len(digits) if len(digits) < 16 else 16}")
        out.append(f"3:balanced{span.count('(') == span.count(')')}")
        out.append(f"3:gaps{min(4, len(re.findall('[^0-9]+', span)))}")
        out.append(f"3:longest{min(8, max(map(len, re.findall('[0-9]+', span))))}")
        out.append(f"3:edge{left.isalnum() or left in ('+', '.') and left != ''}{right.isalnum()}")
    return out


def candidates(text: str, a: int, b: int) -> tuple[list[int], dict[int, list[tuple[int, int, list[str]]]]]:
    """Atom bounds of a window, and for each end its possible entities as (first atom, kind, features)."""
    cut = [a + m.start() for m in _ATOM.finditer(text[a:b])] + [b]
    digits = [0, *accumulate(y - x if text[x] in "0123456789" else 0 for x, y in zip(cut, cut[1:]))]  # before each bound
    out: dict[int, list[tuple[int, int, list[str]]]] = {}
    for i in range(len(cut) - 1):
        c = text[cut[i]]
        if not (c.isascii() and (c in _LOCAL or c == "(")):
            continue
        near = min(i + MAX_ATOMS, len(cut) - 1)
        last = max(near, bisect_right(digits, digits[i] + MAX_DIGITS) - 1)  # numbers may be written digit by digit
        far = cut[last]
        mail = _WHOLE[0].match(text, cut[i], cut[near])
        stop = _WHOLE[3].match(text, cut[i], far) or _WHOLE[1].match(text, cut[i], far) or _WHOLE[2].match(text, cut[i], far)
        reach = max(mail.end() if mail else 0, stop.end() if stop else 0)
        for j in range(i + 1, last + 1):
            if cut[j] > reach:
                break
            if cut[j] - cut[i] < 7 or not text[cut[j] - 1].isalnum():
                continue
            span, n = text[cut[i] : cut[j]], digits[j] - digits[i]
            left, right = text[cut[i] - 1 : cut[i]] if cut[i] else "", text[cut[j] : cut[j] + 1]
            for kind in range(4):
                fits = (mail and "@" in span, n >= 4, 14 <= n <= 19, 7 <= n <= 15)[kind]
                if fits and _WHOLE[kind].fullmatch(span):
                    out.setdefault(j, []).append((i, kind, features(kind, span, left, right)))
    return cut, out


def _score(w: dict[str, float], names: list[str]) -> float:
    return sum(w.get(x, 0.0) for x in names)


def decode(text: str, a: int, b: int, w: dict[str, float]) -> list[tuple[int, int, int]]:
    """The best segmentation of a window: its entities as (start, kind, end)."""
    cut, cand = candidates(text, a, b)
    if not cand:
        return []
    best: list[float] = [0.0] * len(cut)
    back: list[tuple[int, int]] = [(0, -1)] * len(cut)
    for j in range(1, len(cut)):
        best[j], back[j] = best[j - 1], (j - 1, -1)  # outside any entity: score 0
        for i, kind, names in cand.get(j, ()):
            s = best[i] + _score(w, names)
            if s > best[j]:
                best[j], back[j] = s, (i, kind)
    out, j = [], len(cut) - 1
    while j:
        i, kind = back[j]
        if kind >= 0:
            out.append((cut[i], kind, cut[j]))
        j = i
    return out[::-1]


def _generated(rng: random.Random) -> tuple[str, list[tuple[int, int, int]]]:
    """A made-up line with its true entities: entities side by side, and numbers that are none."""
    num = lambda n: "".join(rng.choice("0123456789") for _ in range(n))

    def card() -> str:
        body = rng.choice("3456") + num(14)
        body += next(str(c) for c in range(10) if luhn(body + str(c)))
        return body if rng.random() < 0.6 else rng.choice(" -").join(body[i : i + 4] for i in range(0, 16, 4))

    def phone() -> str:
        x, y, z = num(3), num(3), num(4)
        forms = (f"+{num(1)} ({x}) {y}-{z}", f"({x}) {y}-{z}", f"{x}-{y}-{z}", f"+{num(2)} {num(3)} {num(3)} {num(4)}", f"+{num(11)}", f"{x}.{y}.{z}")
        return forms[min(len(forms) - 1, int(rng.expovariate(0.6)))]

    def bad_card() -> str:
        while luhn(body := num(rng.randint(14, 18))):
            pass
        return body

    word = lambda: "".join(rng.choice("aeinorstlhd") for _ in range(rng.randint(2, 8)))
    entity = (
        lambda: f"{word()}{rng.choice(['', '.' + word(), num(2)])}@{word()}.{rng.choice(['example.com', 'org', 'co.uk', 'net'])}",
        lambda: ".".join(str(rng.randint(0, 255)) for _ in range(4)),
        card,
        phone,
    )
    noise = (
        lambda: f"{num(1)}.{num(1)}", lambda: f"20{num(2)}-0{rng.randint(1, 9)}-{rng.randint(10, 28)}", lambda: num(rng.randint(1, 9)),
        lambda: f"{num(3)}.{num(3)}", lambda: bad_card(), lambda: f"{rng.randint(256, 999)}.{num(2)}.{num(3)}.{rng.randint(256, 999)}", lambda: num(12),
        lambda: ".".join(num(1) for _ in range(5)), lambda: f"{num(4)}-{num(4)}", lambda: f"{num(2)}:{num(2)}:{num(2)}", lambda: f"{num(4)} {num(5)} {num(3)}",
    )
    text, spans = "", []
    for _ in range(rng.randint(2, 5)):
        r = rng.random()
        if r < 0.55:
            kind = rng.randrange(4)
            s = entity[kind]()
            spans.append((len(text), kind, len(text) + len(s)))
        else:
            s = rng.choice(noise)() if r < 0.85 else word()
        text += s + rng.choice([" ", " ", " ", ", ", ". "])
    return text, spans


@functools.cache
def trained(sentences: int = TRAIN_SENTENCES, epochs: int = EPOCHS, seed: int = 7) -> dict[str, float]:
    """Weights by stochastic gradient ascent on log p(segmentation | text), from forward and backward sums."""
    rng, data = random.Random(seed), []
    for _ in range(sentences):
        text, truth = _generated(rng)
        for a, b in windows(text):
            cut, cand = candidates(text, a, b)
            gold = {(s, k, e) for s, k, e in truth if a <= s and e <= b}
            arcs = [(i, j, names, (cut[i], kind, cut[j]) in gold) for j in sorted(cand) for i, kind, names in cand[j]]
            if arcs:
                data.append((len(cut), arcs))
    w: dict[str, float] = {}
    for epoch in range(epochs):
        rng.shuffle(data)
        for n, arcs in data:
            score = [_score(w, names) for _, _, names, _ in arcs]
            into: dict[int, list[int]] = {}
            out: dict[int, list[int]] = {}
            for x, (i, j, _, _) in enumerate(arcs):
                into.setdefault(j, []).append(x)
                out.setdefault(i, []).append(x)
            fore, aft = [0.0] * n, [0.0] * n
            for j in range(1, n):
                fore[j] = _logsum([fore[j - 1], *(fore[arcs[x][0]] + score[x] for x in into.get(j, ()))])
            for i in range(n - 2, -1, -1):
                aft[i] = _logsum([aft[i + 1], *(aft[arcs[x][1]] + score[x] for x in out.get(i, ()))])
            step = RATE / (1 + epoch)
            for x, (i, j, names, is_true) in enumerate(arcs):
                p = math.exp(fore[i] + score[x] + aft[j] - fore[-1])
                if abs(g := is_true - p) > 1e-4:
                    for name in names:
                        w[name] = w.get(name, 0.0) * (1 - DECAY) + step * g
    return w


def _logsum(xs: list[float]) -> float:
    m = max(xs)
    return m + math.log(sum(math.exp(x - m) for x in xs))


# --- documents ---------------------------------------------------------------------------------------------


def find(text: str, w: dict[str, float]) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, all spans), each as (start, kind, end) in code points and in order."""
    base = base_spans(text)
    starts, reach = [x for x, _, _ in base], list(accumulate((y for _, _, y in base), max))
    added = []
    for a, b in windows(text):
        for s, k, e in decode(text, a, b, w):
            before = bisect_left(starts, e)  # base spans that start before this one's end
            if not before or reach[before - 1] <= s:
                added.append((s, k, e))
    return base, sorted(base + added)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def pii_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every whole text.

    Null and empty texts have no spans; repeated rows and rows without an id stay; an empty table gives no rows. A very long text is
    searched in windows that end where no entity can reach over, so its time grows with its length. Of the other columns,
    whatever their names, none is read. Spans of equal start stand in the order of kinds.
    """
    w = trained()

    def kernel(texts: list[str]) -> list[list]:
        found = [find(t, w) for t in texts]
        counts = [[sum(s[1] == k for s in base) for base, _ in found] for k in range(4)]
        return [*counts, [hashlib.sha256(joined(b).encode()).hexdigest() for b, _ in found], [joined(x) for _, x in found]]

    return map_texts(df, id_col, text_col, f"{id_col} long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string", kernel)


def redacted(text: str, w: dict[str, float]) -> str:
    """The text with each found entity replaced by its kind in angle brackets; overlapping ones become one mark."""
    out, at = [], 0
    for a, k, b in find(text, w)[1]:
        if a >= at:
            out += [text[at:a], f"<{KINDS[k].upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact_documents(df: DataFrame, text_col: str = "text", chars_col: str | None = None) -> DataFrame:
    """The same rows and columns with personal data masked; null texts stay null. ``chars_col`` gets the new length."""
    w = trained()
    small_batches(df.sparkSession)

    @F.pandas_udf("string")
    def mask(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t if t is None else redacted(t, w))

    out = df.withColumn(text_col, mask(F.col(f"`{text_col}`")))
    return out.withColumn(chars_col, F.char_length(text_col).cast(df.schema[chars_col].dataType)) if chars_col else out
