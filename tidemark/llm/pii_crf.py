"""Personal data: a character-level bidirectional LSTM with a CRF over it, in numpy.

The network is trained on spans that exact patterns label, and on the same spans varied and rewritten (a phone without its plus,
a spelled-out "at", a bracketed dot, other grouping of digits) so that it finds forms that the patterns don't know. Every
stretch of text around a digit, an "@" or a spelled-out address is cut into overlapping windows; each is decoded by Viterbi, and where windows overlap
the one whose middle is nearest decides, over the whole text. A span that the network adds must be plausible (Luhn, ranges,
number of digits) and must not touch one that the patterns found; those always stay.

Nulls and edge cases: a null text is empty and has no spans; texts are read whole at any length, in time that grows with it; without any labelled span nothing is
added; null ids, repeated rows and empty tables work; extra columns pass through ``redact``, and one that is named like an output of ``find`` is left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import nsmallest

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

KINDS = ["email", "ip", "card", "phone"]
#: The base patterns; matches that fail their check are dropped. Of an address what follows the "@"; of an ip the whole run of numbers and dots.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN, _DOTTED = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD, _PHONE = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT, _NUMBER = re.compile("[0-9]"), re.compile("[0-9]+")
#: Places near which a span may lie. An address that is spelled out has its "at" between spaces or brackets and a dot after the next word.
_GATE = re.compile(r"[0-9@]|[ \[(][aA][tT][ \])] ?[A-Za-z0-9-]+(?: ?[\[(]? ?[dD][oO][tT]| ?[\[(]? ?\.)[\])]? ?[A-Za-z0-9]")
_WORD, _TAIL, _DIGITS = re.compile(r"[A-Za-z0-9._%+-]*"), re.compile(r"[A-Za-z0-9-]*(?:\.[A-Za-z0-9-]+)*"), re.compile("[0-9]*")
#: Windows that the fit sees at most, half of them labelled ones where there are so many, by hash of their text; places of a window, its step,
#: and context around a gate, which grows on to the ends of its words.
FIT_WINDOWS, WIDTH, STEP, MARGIN = 1_500, 64, 32, 24
Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    d = [int(x) for x in reversed(digits)]
    return (sum(d[0::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def _byte(x: str) -> bool:
    x = x.lstrip("0")
    return len(x) <= 3 and int(x or 0) <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """Runs of numbers and dots hold a match for every four numbers."""
    for m in _DOTTED.finditer(text):
        if m[0].count(".") > 2:
            numbers = [*_NUMBER.finditer(text, m.start(), m.end())]
            for i in range(0, len(numbers) - 3, 4):
                if all(_byte(x[0]) for x in numbers[i : i + 4]):
                    yield numbers[i].start(), numbers[i + 3].end()


def base_spans(text: str) -> list[Span]:
    """Spans of the base patterns, by kind and then start."""
    out: list[Span] = [("email", a, z) for a, z in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        out += [("ip", a, z) for a, z in _ips(text)]
        for kind, p, least, most in (("card", _CARD, 16, 19), ("phone", _PHONE, 8, 15)):
            for m in p.finditer(text):
                digits = "".join(_NUMBER.findall(m[0]))
                if least <= len(digits) <= most and (kind == "phone" or luhn(digits)):
                    out.append((kind, m.start(), m.end()))
    return out


_DOT = r"(?: ?[\[(]? ?(?:\.|[dD][oO][tT]) ?[\])]? ?)"
_SPELLED = re.compile(rf"[A-Za-z0-9._%+-]+(?: ?[\[(] ?(?:@|[aA][tT]) ?[\])] ?| ?@ ?| [aA][tT] )[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)+")
_PARTED, _GROUPED = re.compile(rf"[0-9]{{1,3}}(?:{_DOT}[0-9]{{1,3}}){{3}}"), re.compile(r"[0-9](?:(?: - |[ ./_-]{1,2})?[0-9])+")
_DIALLED = re.compile(r"[+(]?[0-9](?:[ ()./-]{1,2}[0-9]+|[0-9])+")


_SHAPES = {"email": _SPELLED, "ip": _PARTED, "card": _GROUPED, "phone": _DIALLED}


#: A plain word, "at" and a host that is written as hosts are: prose ("arrived at example.com"), not a rewritten address.
_PROSE = re.compile(r"[A-Za-z]+ [aA][tT] [A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: What stands before numbers of things, and before those of telephones.
_LABEL, _TELEPHONE = re.compile(r"(?i)(?:\b(?:no|nr|order|invoice|ref|id|isbn|version)\b[.:# ]*|#)$"), re.compile(r"(?i)\b(?:tel|phone|telephone|fax|mobile|cell|call)\b")
LABEL_CHARS = 24


def plausible(kind: str, s: str, before: str = "") -> bool:
    """The exact check of a span that the network adds. ``before``: the text in front of it, of which :data:`LABEL_CHARS` characters tell numbers of things from telephones."""
    if kind == "email":
        return bool(_SPELLED.fullmatch(s)) and not _PROSE.fullmatch(s)
    numbers = _NUMBER.findall(s)
    digits = "".join(numbers)
    if kind == "ip":
        return bool(_PARTED.fullmatch(s)) and all(map(_byte, numbers))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits) and bool(_GROUPED.fullmatch(s))
    before = before[-LABEL_CHARS:]
    return 9 <= len(digits) <= 15 and 3 <= len(numbers) <= 5 and bool(_DIALLED.fullmatch(s)) and not (_LABEL.search(before) and not _TELEPHONE.search(before))


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches that may hold personal data: everything near a gate, to the ends of words, merged."""
    out: list[list[int]] = []
    for m in _GATE.finditer(text):
        a, z = max(0, m.start() - MARGIN), min(len(text), m.end() + MARGIN)
        if not out or z > out[-1][1]:
            z = _WORD.match(text, z).end()
        if out and a <= out[-1][1]:
            out[-1][1] = max(z, out[-1][1])
        else:
            least = out[-1][1] if out else 0
            while a > least and text[a - 1] in _LOCAL:
                a -= 1
            if out and a <= out[-1][1]:
                out[-1][1] = z
            else:
                out.append([a, z])
    return [(a, z) for a, z in out]


def _starts(a: int, z: int) -> list[int]:
    """Where the windows of a region start; the last one ends with it."""
    return [*range(a, z - WIDTH, STEP), max(a, z - WIDTH)]


_CODES = np.full(128, 2, dtype=np.int64)
_CODES[10], _CODES[32:127] = 3, np.arange(4, 99)
N_CODES, N_TAGS = 99, 1 + 2 * len(KINDS)


def encode(s: str) -> np.ndarray:
    """Character classes; 0 is padding, 1 any other letter, 2 other characters."""
    p = np.fromiter(map(ord, s), dtype=np.int64, count=len(s))
    return np.where(p < 128, _CODES[np.minimum(p, 127)], 1)


class Tagger:
    """Embedding, two LSTMs, emissions and CRF transitions."""

    def __init__(self, size: int = 24, width: int = 12, seed: int = 7, kind: type = np.float64):
        r, h = np.random.default_rng(seed), size
        self.h = h
        self.p = {"emb": r.normal(0, 0.3, (N_CODES, width)), "out": r.normal(0, 0.2, (2 * h, N_TAGS)), "bias": np.zeros(N_TAGS), "trans": np.zeros((N_TAGS, N_TAGS))}
        for d in "fb":
            self.p |= {f"x{d}": r.normal(0, 0.25, (width, 4 * h)), f"h{d}": r.normal(0, 0.25, (h, 4 * h)), f"c{d}": np.concatenate([np.zeros(h), np.ones(h), np.zeros(2 * h)])}
        self.p = {k: x.astype(kind) for k, x in self.p.items()}

    def _run(self, codes: np.ndarray, keep: list | None) -> np.ndarray:
        """States of both directions at each place; the two run side by side, the second over the reversed text."""
        p, h = self.p, self.h
        n, steps = codes.shape
        inner = np.stack([(p["emb"] @ p[f"x{d}"] + p[f"c{d}"])[c.T] for d, c in (("f", codes), ("b", codes[:, ::-1]))], 1)
        w = np.stack([p["hf"], p["hb"]])
        state, cell, out = np.zeros((2, n, h), inner.dtype), np.zeros((2, n, h), inner.dtype), np.zeros((steps, 2, n, h), inner.dtype)
        for t in range(steps):
            z = inner[t] + state @ w
            z[..., : 3 * h] *= 0.5
            z = np.tanh(z)
            g, c = 0.5 * z[..., : 3 * h] + 0.5, z[..., 3 * h :]
            before, held = cell, state
            cell = g[..., h : 2 * h] * cell + g[..., :h] * c
            tc = np.tanh(cell)
            state = g[..., 2 * h :] * tc
            out[t] = state
            if keep is not None:
                keep.append((g, c, before, held, tc))
        return np.concatenate([out[:, 0], out[::-1, 1]], 2).transpose(1, 0, 2)

    def emissions(self, codes: np.ndarray) -> np.ndarray:
        return self._run(codes, None) @ self.p["out"] + self.p["bias"]

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """The best tags of each row (Viterbi)."""
        e, trans = self.emissions(codes), self.p["trans"]
        n, steps, _ = e.shape
        score, back = e[:, 0], np.zeros((n, steps, N_TAGS), dtype=np.int8)
        for t in range(1, steps):
            s = score[:, :, None] + trans[None]
            back[:, t] = s.argmax(1)
            score = s.max(1) + e[:, t]
        tags = np.zeros((n, steps), dtype=np.int8)
        tags[:, -1] = score.argmax(1)
        for t in range(steps - 1, 0, -1):
            tags[:, t - 1] = back[np.arange(n), t, tags[:, t]]
        return tags

    def gradients(self, codes: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the CRF and its gradients. Forward and backward sums are scaled to one at each place."""
        p, h = self.p, self.h
        n, steps = codes.shape
        keep: list = []
        both = np.ascontiguousarray(self._run(codes, keep))
        e, trans = both @ p["out"] + p["bias"], p["trans"]
        top, move = e.max(2, keepdims=True), np.exp(trans)
        local, scale = np.exp(e - top), np.zeros((n, steps), e.dtype)
        ahead, behind = np.zeros_like(e), np.ones_like(e)
        for t in range(steps):
            x = ahead[:, t - 1] @ move * local[:, t] if t else local[:, 0]
            scale[:, t] = x.sum(1)
            ahead[:, t] = x / scale[:, t, None]
        for t in range(steps - 2, -1, -1):
            behind[:, t] = ((behind[:, t + 1] * local[:, t + 1]) @ move.T) / scale[:, t + 1, None]
        z = np.log(scale).sum(1) + top[..., 0].sum(1)
        rows, cols = np.arange(n)[:, None], np.arange(steps)[None, :]
        gold = e[rows, cols, tags].sum(1) + trans[tags[:, :-1], tags[:, 1:]].sum(1)
        de = ahead * behind
        de[rows, cols, tags] -= 1
        de /= n
        arrive = (local[:, 1:] * behind[:, 1:] / scale[:, 1:, None]).reshape(-1, N_TAGS)
        pair = move * (ahead[:, :-1].reshape(-1, N_TAGS).T @ arrive)
        pair -= np.bincount((tags[:, :-1] * N_TAGS + tags[:, 1:]).ravel(), minlength=N_TAGS**2).reshape(N_TAGS, N_TAGS).astype(e.dtype)
        g = {"trans": pair / n, "out": both.reshape(n * steps, -1).T @ de.reshape(n * steps, -1), "bias": de.sum((0, 1)), "emb": np.zeros_like(p["emb"])}
        back, one = de @ p["out"].T, np.eye(N_CODES, dtype=e.dtype)[codes.T.ravel()]
        back = np.stack([back[:, :, :h].transpose(1, 0, 2), back[:, ::-1, h:].transpose(1, 0, 2)], 1)
        w = np.stack([p["hf"].T, p["hb"].T])
        dz_all, gh = np.zeros((steps, 2, n, 4 * h), e.dtype), np.zeros((2, h, 4 * h), e.dtype)
        dstate, dcell = np.zeros((2, n, h), e.dtype), np.zeros((2, n, h), e.dtype)
        for t in range(steps - 1, -1, -1):
            gate, c, before, held, tc = keep[t]
            ds = back[t] + dstate
            gi, gf, go = gate[..., :h], gate[..., h : 2 * h], gate[..., 2 * h :]
            dc = ds * go * (1 - tc * tc) + dcell
            dz, slope = dz_all[t], gate * (1 - gate)
            dz[..., :h], dz[..., h : 2 * h], dz[..., 2 * h : 3 * h], dz[..., 3 * h :] = dc * c, dc * before, ds * tc, dc * gi * (1 - c * c)
            dz[..., : 3 * h] *= slope
            gh += held.transpose(0, 2, 1) @ dz
            dstate, dcell = dz @ w, dc * gf
        for i, d in enumerate("fb"):
            dz = (dz_all[:, 0] if d == "f" else dz_all[::-1, 1]).reshape(-1, 4 * h)
            table = one.T @ dz
            g |= {f"h{d}": gh[i], f"c{d}": dz.sum(0), f"x{d}": p["emb"].T @ table}
            g["emb"] += table @ p[f"x{d}"].T
        return float((z - gold).mean()), g

    def fit(self, codes: np.ndarray, tags: np.ndarray, *, epochs: int = 4, steps: int = 900, batch: int = 64, rate: float = 0.012, seed: int = 7) -> Tagger:
        """Adam, for ``epochs`` rounds over the rows and ``steps`` batches at least; deterministic."""
        r, m, v, k = np.random.default_rng(seed), {}, {}, 0
        epochs = max(epochs, -(-steps * batch // max(1, len(codes))))
        for epoch in range(epochs):
            order = r.permutation(len(codes))
            for a in range(0, len(order), batch):
                pick = order[a : a + batch]
                _, g = self.gradients(codes[pick], tags[pick])
                norm, k = np.sqrt(sum((x * x).sum() for x in g.values())), k + 1
                for name, x in g.items():
                    x = x * min(1.0, 5 / (norm + 1e-9))
                    m[name] = 0.9 * m.get(name, 0) + 0.1 * x
                    v[name] = 0.999 * v.get(name, 0) + 0.001 * x * x
                    self.p[name] -= rate * 0.125 ** (epoch / epochs) * (m[name] / (1 - 0.9**k)) / (np.sqrt(v[name] / (1 - 0.999**k)) + 1e-8)
        return self


def tags_of(spans: list[Span], length: int) -> np.ndarray:
    out = np.zeros(length, dtype=np.int64)
    for kind, a, b in spans:
        k = KINDS.index(kind)
        a0, a, b = a, max(0, a), min(length, b)
        if a < b:
            out[a:b] = 2 + 2 * k
            if a0 >= 0:
                out[a] = 1 + 2 * k
    return out


def _pick(r: np.random.Generator, *ways: str) -> str:
    return ways[int(r.integers(len(ways)))]


def _varied(kind: str, s: str, words: list[str], r: np.random.Generator) -> str:
    """Another datum of the same form: other digits, and words of the corpus for the words of an address. A card keeps its check digit right."""
    if kind == "email":
        word = lambda: words[int(r.integers(len(words)))] if words else "name"
        if r.random() < 0.4:
            return re.sub(r"[A-Za-z]{3,}", lambda m: word() if r.random() < 0.7 else m[0], s)
        some = lambda most, *seps: _pick(r, *seps).join(word() + (str(int(r.integers(100))) if r.random() < 0.25 else "") for _ in range(int(r.integers(1, most + 1))))
        return f"{some(4, '.', '_', '-')}@{some(2, '.', '-')}.{_pick(r, 'com', 'org', 'net', 'de', 'co.uk', 'io', s[s.rindex('.') + 1 :])}"
    if kind == "ip":
        return ".".join(str(int(r.integers(256))) for _ in range(4))
    new = [str(int(r.integers(10))) if c.isdigit() else c for c in s]
    if kind == "card":
        last = max(i for i, c in enumerate(s) if c.isdigit())
        new[last] = next(d for d in "0123456789" if luhn("".join(_NUMBER.findall("".join([*new[:last], d])))))
    return "".join(new)


def rewritten(kind: str, s: str, r: np.random.Generator) -> str:
    """Another way to write the same datum."""
    dot = _pick(r, " dot ", "[.]", "(.)", "[dot]", "(dot)", " (dot) ", " [dot] ", " DOT ", " . ")
    if kind == "email":
        name, _, host = s.partition("@")
        return name + _pick(r, " at ", "[at]", "(at)", " (at) ", " [at] ", " AT ") + host.replace(".", _pick(r, ".", dot))
    if kind == "ip":
        return s.replace(".", dot)
    digits = "".join(_NUMBER.findall(s))
    if kind == "card":
        return _pick(r, ".", "/", "_", " - ", "  ").join(digits[i : i + 4] for i in range(0, len(digits), 4))
    sep, n = _pick(r, " ", "-", ".", "/"), len(digits)
    body = [digits[max(0, n - 10) : n - 7], digits[n - 7 : n - 4], digits[n - 4 :]]
    if r.random() < 0.4 and body[0]:
        body[0] = f"({body[0]})"
        return _pick(r, "", digits[: max(0, n - 10)] + sep if n > 10 else "") + body[0] + _pick(r, " ", "", sep) + sep.join(body[1:])
    return sep.join([*([digits[: n - 10]] if n > 10 and r.random() < 0.5 else []), *(x for x in body if x)])


def _other_number(r: np.random.Generator) -> str:
    """Numbers that are no personal data."""
    d = lambda n: "".join(str(int(x)) for x in r.integers(0, 10, n))
    return _pick(r, f"{d(4)}-{d(2)}-{d(2)}", f"{d(2)}.{d(2)}.{d(4)}", f"{d(2)}:{d(2)}:{d(2)}", f"{d(1)}.{d(1)}.{d(1)}", f"{d(3)},{d(3)}", f"{d(2)}.{d(2)}", f"{d(4)}/{d(2)}", f"no. {d(6)}", d(int(r.integers(1, 20))), f"{d(4)}-{d(2)}-{d(2)} {d(2)}:{d(2)}", f"978-{d(1)}-{d(2)}-{d(6)}-{d(1)}", f"{d(1)}.{d(3)}.{d(3)}", f"{d(2)} at {d(2)}.{d(2)}")


def _examples(windows: int):
    """Distinct windows (w, h, spans), at most ``windows`` labelled and as many others from each task, those of the smallest hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        held: list[dict[str, tuple[int, str]]] = [{}, {}]
        for b in batches:
            for text in b.column(0).to_pylist():
                if not text or not _GATE.search(text):
                    continue
                spans = base_spans(text)
                for a, z in regions(text):
                    for s in _starts(a, z):
                        w = text[s : s + WIDTH]
                        own = ",".join(f"{k}:{x - s}:{y - s}" for k, x, y in spans if x < s + len(w) and y > s)
                        held[bool(own)][w] = (xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) >> 1, own)
            for i in (0, 1):
                if len(held[i]) > 4 * windows:
                    held[i] = dict(nsmallest(windows, held[i].items(), key=lambda x: x[1]))
        rows = [x for one in held for x in nsmallest(windows, one.items(), key=lambda x: x[1])]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows], pa.string()), pa.array([x[0] for _, x in rows], pa.int64()), pa.array([x[1] for _, x in rows], pa.string())], ["w", "h", "spans"])

    return run


def padded(windows: list[str]) -> np.ndarray:
    out = np.zeros((len(windows), WIDTH), dtype=np.int64)
    for i, w in enumerate(windows):
        out[i, : len(w)] = encode(w)
    return out


def fit_windows(rows: list[tuple[str, list[Span]]], seed: int = 7, examples: int = 8_000) -> Tagger | None:
    """Train on labelled windows, varied and rewritten copies of their spans between pieces of other windows (about ``examples`` in all), and
    numbers that are nothing; None without a labelled span."""
    r, texts, tags = np.random.default_rng(seed), [], []
    plain = [w for w, spans in rows if not spans] or [" "]
    words = sorted({x for w in plain for x in re.findall(r"(?<![A-Za-z])[A-Za-z]{3,12}(?![A-Za-z])", w)})

    def add(text: str, spans: list[Span]) -> None:
        at = int(r.integers(len(text) - WIDTH + 1)) if len(text) > WIDTH else 0
        text = text[at : at + WIDTH]
        texts.append(text)
        tags.append(np.append(tags_of([(k, a - at, z - at) for k, a, z in spans if z > at], len(text)), np.zeros(WIDTH - len(text), dtype=np.int64)))

    def between(new: str) -> tuple[str, str]:
        left, right = (plain[int(r.integers(len(plain)))] for _ in "ab")
        cut = int(r.integers(8, WIDTH - 8))
        space = "" if r.random() < 0.05 else " "
        return left[:cut] + space, _pick(r, " ", ". ", ", ", "\n", ")") + right[: WIDTH - 8]

    count = {kind: sum(s[0] == kind for _, spans in rows for s in spans) for kind in KINDS}
    # Addresses have the most forms, phone numbers are the most like other numbers.
    share = {"email": 3, "phone": 2, "ip": 1, "card": 1}
    copies = {kind: min(500, max(4, share[kind] * examples // (7 * max(1, n)))) for kind, n in count.items()}
    for w, spans in rows:
        add(w, spans)
        whole = [s for s in spans if s[1] >= 0 and s[2] <= len(w) and (s[1] > 0 or s[2] < WIDTH)]
        for kind, a, z in whole:
            for i in range(copies[kind]):
                new = _varied(kind, w[a:z], words, r) if i else w[a:z]
                new = rewritten(kind, new, r) if i != 1 else new
                left, right = between(new) if i > 1 or len(spans) > 1 else (w[:a], w[z:])
                add(left + new + right, [(kind, len(left), len(left) + len(new))])
    if not any(t.any() for t in tags):
        return None
    for _ in range(len(texts) // 4):
        new = _other_number(r)
        left, right = between(new)
        add(left + new + right, [])
    return Tagger(kind=np.float32).fit(padded(texts), np.stack(tags))


def fit_spans(docs: DataFrame, text: str = "text", *, windows: int = FIT_WINDOWS) -> Tagger | None:
    """Train on at most ``windows`` distinct windows of the corpus, half of them labelled if there are so many, those of the smallest hashes."""
    small_batches(docs.sparkSession)
    found = docs.select(text).mapInArrow(_examples(windows), "w string, h long, spans string").groupBy("w").agg(F.min("h").alias("h"), F.max("spans").alias("spans"))
    rows = found.where("spans != ''").orderBy("h", "w").limit(windows // 2).collect()
    rows += found.where("spans = ''").orderBy("h", "w").limit(windows - len(rows)).collect()
    parse = lambda s: [(k, int(a), int(b)) for k, a, b in (x.split(":") for x in s.split(",") if x)]
    return fit_windows([(r["w"], parse(r["spans"])) for r in rows])


def _to_words(text: str, kind: str, x: int, y: int) -> tuple[int, int]:
    """A decoded span without space and stops around it, up to the ends of its words or numbers; where more was decoded than a datum of
    its kind, the longest that it holds."""
    s = text[x:y]
    x, y = x + len(s) - len(s.lstrip(" \n.,;:")), y - len(s) + len(s.rstrip(" \n.,;:"))
    if x >= y:
        return x, y
    while x > 0 and (text[x - 1] in _LOCAL if kind == "email" else text[x - 1].isdigit()):
        x -= 1
    y = _TAIL.match(text, y).end() if kind == "email" else _DIGITS.match(text, y).end()
    if not _SHAPES[kind].fullmatch(text, x, y):
        x, y = max((m.span() for m in _SHAPES[kind].finditer(text, x, y)), key=lambda s: s[1] - s[0], default=(x, x))
    return x, y


def added_spans(model: Tagger | None, texts: list[str], found: list[list[Span]]) -> list[list[Span]]:
    """Spans that the network adds to those found in each text; windows of all texts are decoded together."""
    places, windows = [], []
    if model is None:
        return [[] for _ in texts]
    for i, text in enumerate(texts):
        for a, z in regions(text):
            for s in _starts(a, z):
                places.append((i, a, z, s))
                windows.append(text[s : min(s + WIDTH, z)])
    out: list[list[Span]] = [[] for _ in texts]
    tags = np.concatenate([model.decode(padded(windows[k : k + 2048])) for k in range(0, len(windows), 2048)]) if windows else []
    k = 0
    while k < len(places):
        i, a, z, _ = places[k]
        best, far = np.zeros(z - a, dtype=np.int64), np.full(z - a, 1 << 30)
        while k < len(places) and places[k][:2] == (i, a):
            s, n = places[k][3], len(windows[k])
            away = np.abs(2 * np.arange(n) + 1 - n)
            own = slice(s - a, s - a + n)
            nearer = away < far[own]
            best[own], far[own] = np.where(nearer, tags[k][:n], best[own]), np.where(nearer, away, far[own])
            k += 1
        at = 0
        while at < z - a:
            if not best[at]:
                at += 1
                continue
            kind, end = (best[at] - 1) // 2, at + 1
            while end < z - a and best[end] == 2 + 2 * kind:
                end += 1
            x, y = a + at, a + end
            x, y = _to_words(texts[i], KINDS[kind], x, y)
            if x < y and all(y <= u or x >= v for _, u, v in found[i] + out[i]) and plausible(KINDS[kind], texts[i][x:y], texts[i][max(0, x - LABEL_CHARS) : x]):
                out[i].append((KINDS[kind], x, y))
            at = end
    return out


def _spans(model: Tagger | None, texts: list[str]) -> tuple[list[list[Span]], list[list[Span]]]:
    base = [base_spans(t) if _GATE.search(t) else [] for t in texts]
    more = added_spans(model, texts, base)
    return base, [sorted(b + m, key=lambda s: (KINDS.index(s[0]), s[1])) if m else b for b, m in zip(base, more, strict=True)]


def find(docs: DataFrame, model: Tagger | None, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, base and spans of each whole text: arrays of (kind, start, end), by kind and start; code points, end exclusive."""
    small_batches(docs.sparkSession)
    kind, span = docs.schema[key].dataType.simpleString(), "array<struct<kind: string, start: int, end: int>>"
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            both = _spans(model, [t or "" for t in b.column(1).to_pylist()])
            cols = [pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in x] for x in one], arrow) for one in both]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], [key, "base", "spans"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, base {span}, spans {span}")


def redact(docs: DataFrame, model: Tagger | None, *, text: str = "text") -> DataFrame:
    """``docs`` with every span of its text replaced by its kind in brackets; where a column n_chars is there, it follows."""
    small_batches(docs.sparkSession)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(text).to_pylist()
            for i, spans in enumerate(_spans(model, [t or "" for t in texts])[1]):
                end = len(texts[i] or "")
                for kind, a, z in sorted(spans, key=lambda s: (-s[2], s[1])):
                    if z <= end:
                        texts[i], end = f"{texts[i][:a]}[{kind.upper()}]{texts[i][z:]}", a
                    elif a < end:  # spans of two kinds overlap: what is left of the earlier one goes too
                        texts[i], end = texts[i][:a] + texts[i][end:], a
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if n == text else b.column(n) for n in names], names)

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.coalesce(F.length(text).cast(docs.schema["n_chars"].dataType), F.col("n_chars"))).select(*names)
    return out
