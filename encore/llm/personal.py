"""Personal data: generators propose overlapping spans, boosted trees score them, calibrated thresholds select.

Exact rules give the base spans (e-mail and IP addresses, card and telephone numbers). Looser generators propose many
more spans, which overlap each other and the base ones; trees that see a span's format and context learn to tell
personal data from what looks alike, and what passes its kind's threshold and overlaps no base span is added. They learn
from loose forms that no rule matches: base spans, written in other ways, and look-alikes in their place.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left
from itertools import islice, repeat

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.boosting import Trees, coded
from encore.llm.common import map_batches, map_rows, saved

KINDS = ("email", "ip", "card", "phone")
#: Candidates up to which the trees are fitted in one place, and from which on by sums where the rows lie, so many in a task.
TOGETHER, TASK_ROWS = 30_000, 100_000
#: Steps in which chances are told apart for the thresholds of many rows.
STEPS = 10_000
#: Share of right spans that a threshold must reach on rows held out.
PRECISION = 0.99
SHAPE = {"rounds": 120, "depth": 4}
#: Times that a base span is written in other ways, half of them look-alikes.
VERSIONS = 16

# Fixed patterns of the base rules.
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9](?<![0-9]{2})[0-9]*\.[0-9]+\.[0-9]+\.[0-9]+")  # from where a number begins
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: Each digit of a card number that counts twice, as what it adds.
_TWICE = str.maketrans("0123456789", "0246813579")


def luhn(digits: str) -> bool:
    """The check of card numbers: from the right, every second digit doubled, digits of all added, divisible by ten."""
    return sum(map(int, digits[::-2] + digits[-2::-2].translate(_TWICE))) % 10 == 0


def _numbered(text: str) -> bool:
    return any(map(text.__contains__, "0123456789"))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) by the exact rules, sorted. Linear in the text."""
    out = []
    at, last = text.find("@"), 0
    while at >= 0:  # a match starts where the run of local characters before its @ does
        start = at
        while start > last and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        last = m.end() if m else at + 1
        if m:
            out.append((start, 0, last))
        at = text.find("@", last)
    if not _numbered(text):
        return out
    for m in _IP.finditer(text) if "." in text else ():
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m.group().split("."))):
            out.append((m.start(), 1, m.end()))
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 10 <= sum(map("0123456789".__contains__, m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


#: Generators: loose patterns and the kinds that they propose. Addresses are looked for around their sign, numbers in
#: stretches of digits and what may stand between them.
_SIGNS = ("@", "(at)", "[at]", "{at}")
_AT = re.compile(r" ?(?:@|\(at\)|\[at\]|\{at\}) ?")
_BEFORE = re.compile(r"[\w.%+-]{1,64}\Z")
_LABEL = re.compile(r"[\w-]{1,63}")
_MORE = re.compile(r" ?(?:\.|\(dot\)|\[dot\]) ?[\w-]{1,63}")
_STRETCH = re.compile(r"[0-9][0-9A-Fa-f ()./_,:+-]{5,}")
_NUMBERS = [
    (re.compile(r"(?<![\d.])\d{1,4}(?: ?[.,] ?\d{1,4}){3}(?![\d])"), (1,)),
    (re.compile(r"(?<!\w)[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){4,7}(?!\w)"), (1,)),
    (re.compile(r"(?<!\d)\d(?:[ ./_-]{0,2}\d){11,20}(?!\d)"), (2, 3)),
    (re.compile(r"(?<!\d)(?:\+ ?|00)?\(?\d(?:[ ()./-]{0,3}\d){6,15}(?!\d)"), (3, 2)),
]
#: Words that tell of a kind when they stand before a span.
_CUES = [
    frozenset("email e-mail mail contact write adresse correo courriel".split()),
    frozenset("ip ips host server address addr ping dirección".split()),
    frozenset("card visa mastercard amex credit debit cc karte carte tarjeta".split()),
    frozenset("phone tel telephone call fax mobile cell telefon téléphone teléfono".split()),
]
_WORD = re.compile(r"[^\W\d_]+")
#: What stands before an address' last label, and an address that goes on.
_LAST, _GOES_ON = re.compile(r"\.|\(dot\)|\[dot\]|\)|\]"), re.compile(r" \. \w|\.\w| ?[(\[]dot[)\]]")

#: What features tell of a span's signs.
_NUMBER, _HEX, _BETWEEN, _NEXT = re.compile(r"[0-9]+"), re.compile(r"[0-9A-Fa-f]+"), re.compile(r"[^0-9A-Fa-f]+"), re.compile(r"\w\. \w")


def candidates(text: str) -> list[tuple[int, int, int]]:
    """Distinct (start, kind, end) that the generators propose; they overlap."""
    out = set()
    for m in _AT.finditer(text) if any(map(text.__contains__, _SIGNS)) else ():
        left = _BEFORE.search(text[max(0, m.start() - 64) : m.start()])
        right = _LABEL.match(text, m.end())
        for _ in range(6 if left and right else 0):  # where the address ends, or the next sentence begins, is for the trees
            right = _MORE.match(text, right.end())
            if not right:
                break
            out.add((m.start() - len(left.group()), 0, right.end()))
    for zone in _STRETCH.finditer(text) if _numbered(text) else ():
        for pattern, kinds in _NUMBERS:
            for m in pattern.finditer(text, max(0, zone.start() - 4), zone.end()):
                out.update((m.start(), k, m.end()) for k in kinds)
    return sorted(out)


def features(text: str, span: tuple[int, int, int]) -> list[float]:
    """Format of a candidate and context around it."""
    start, kind, end = span
    s = text[start:end]
    groups = _NUMBER.findall(s)
    digits = "".join(groups)
    parts = [int(g[:6]) for g in groups]
    before, after = text[start - 1 : start], text[end : end + 1]
    left, right = text[max(0, start - 40) : start], text[end : end + 40]
    said = {w.lower() for w in _WORD.findall(left)[-4:]}
    last = _LAST.split(s)[-1]
    years = [len(g) == 4 and g[:2] in ("19", "20") for g in groups]
    return [
        float(kind), len(s), len(digits), len(groups), max(map(len, groups), default=0), min(map(len, groups), default=0),
        max(parts, default=0), s.count("."), s.count("-"), s.count(" "), s.count("@"), s.count(":"), s.count("(") + s.count("["),
        s.count("/") + s.count("_") + s.count(","), s[0] == "+", s[0] == "(", sum(map(str.isalpha, s)), not s.isascii(),
        14 <= len(digits) <= 19 and luhn(digits), digits[:1] in ("3", "4", "5", "6"), len(set(digits)),
        before.isalnum(), after.isalnum(), before in "+.-@/#=$", after in "+.-@/#=%", bool(said & _CUES[kind]),
        any(said & c for i, c in enumerate(_CUES) if i != kind), sum(map(str.isdigit, left)), sum(map(str.isdigit, right)),
        len(s.rsplit(".", 1)[-1]) if "." in s else 0,
        len(last), last.isalpha(), len(_NEXT.findall(s)), bool(_GOES_ON.match(text, end)), s[:2] == "00",
        len(groups[0]) if groups else 0, len(groups[-1]) if groups else 0, len(groups[1]) if len(groups) > 1 else 0,
        any(years), s.count(","), s.count("/"), s.count("::"), before == "-" or before.isalpha(),
        max(map(len, _HEX.findall(s)), default=0),
        len(groups) == 4 and max(parts) <= 255 and "," not in s, 10 <= len(digits) <= 15,
        len(set(_BETWEEN.findall(s))),
    ]


class Detector:
    """Trees over candidates with a threshold for each kind."""

    def __init__(self, trees: Trees, thresholds: list[float]) -> None:
        self.trees, self.thresholds = trees, thresholds

    def chosen(self, rows: list[list[float]]) -> list[tuple[float, bool]]:
        """The chance of each candidate, and whether its kind's threshold selects it."""
        if not rows:
            return []
        chance = self.trees.chance(np.array(rows, float))
        return [(p, p >= self.thresholds[int(r[0])]) for p, r in zip(chance.tolist(), rows, strict=True)]


class _Cover:
    """What spans cover, as sorted ranges that do not touch."""

    def __init__(self, found: list[tuple[int, int, int]]) -> None:
        self.starts, self.ends = [], []
        for start, _, end in found:  # sorted by start
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def free(self, start: int, end: int) -> bool:
        at = bisect_left(self.starts, end)
        return not at or self.ends[at - 1] <= start

    def add(self, start: int, end: int) -> None:
        """A free range."""
        at = bisect_left(self.starts, start)
        self.starts.insert(at, start)
        self.ends.insert(at, end)


def spans(texts: list[str | None], detector: Detector | None) -> list[tuple[list, list]]:
    """Base spans, and base and added spans, of each text (null: of an empty one)."""
    found, covers, rows, owner = [], [], [], []
    for i, t in enumerate(texts):
        base = base_spans(t) if t else []
        found.append((base, list(base)))
        covers.append(_Cover(base))
        for c in candidates(t) if t and detector else ():
            if covers[i].free(c[0], c[2]):
                rows.append(features(t, c))
                owner.append((i, c))
    chosen = detector.chosen(rows) if detector else []
    for _, i, c in sorted((-p, i, c) for (p, good), (i, c) in zip(chosen, owner, strict=True) if good):
        if covers[i].free(c[0], c[2]):  # the likelier of two that overlap
            covers[i].add(c[0], c[2])
            found[i][1].append(c)
    return [(base, sorted(every)) for base, every in found]


def loosened(rng: random.Random, kind: int, s: str) -> str:
    """A base span as people write it where no rule matches: other or spelled-out signs, blanks, no plus."""
    if kind == 0:
        local, domain = s.split("@", 1)
        if rng.random() < 0.5:  # of any length, not only as long as in this sample
            local = local.strip(".").split(".")[0] or local
            domain = f"{domain.split('.')[-2]}.{rng.choice(['com', 'org', 'net', 'info', 'de', 'fr', 'es', 'io'])}"
        at = rng.choice([" @ ", " @ ", "@ ", " @", " (at) ", "(at)", " [at] ", "[at]", " {at} "])
        dot = rng.choice([".", ".", " (dot) ", "(dot)", " [dot] ", " . "])
        return local + at + domain.replace(".", dot)
    digits = "".join(c for c in s if c in "0123456789")
    if kind == 1:
        if rng.random() < 0.5:
            return rng.choice([" . ", ". ", " ."]).join(s.split("."))
        groups = ["2001", "0db8", *(f"{rng.randrange(1, 65536):x}" for _ in range(6))]
        groups[0] = rng.choice(["2001", "2a02", "2606", "2400"])
        if rng.random() < 0.5:
            groups[3:5] = [""]
        return ":".join(groups)
    if kind == 2:
        return rng.choice([". ", ".", "/", "_", "  ", " - "]).join(digits[i : i + 4] for i in range(0, len(digits), 4))
    own = digits[-10:]
    cut = rng.choice([3, 3, 2, 4])
    a, b, c = own[:cut], own[cut : cut + 3], own[cut + 3 :]
    near = [f"({a}) {b}-{c}", f"({a}) {b}-{c}", f"({a}) {b} {c}", f"({a}){b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"0{a}/{b}{c}"]
    code = rng.choice([digits[:-10] or "1", "1", "49", "34", "33", "44", "351"])
    far = [f"00{code} {a} {b}{c}", f"00{code} {a} {b} {c}", f"00{code}{a}{b}{c}", f"00{code}-{a}-{b}-{c}", f"{code} {a} {b} {c}", f"+ {code} {a} {b}{c}", f"+{code}/{a}/{b}{c}"]
    return rng.choice(near if rng.random() < 0.5 else far)


#: Digits by four random bits, as ``random.choice`` takes them; others are drawn anew.
_DRAWN = (*"0123456789", *[""] * 6)


def alike(rng: random.Random) -> str:
    """What the generators propose too, but is nobody's: dates, versions, numbers of orders and books, amounts, prices."""
    drawn = filter(None, map(_DRAWN.__getitem__, map(rng.getrandbits, repeat(4))))
    d = lambda n: "".join(islice(drawn, n))
    year, month, day = rng.randrange(1950, 2040), rng.randrange(1, 13), rng.randrange(1, 29)
    time = f"{rng.randrange(24):02}:{rng.randrange(60):02}:{rng.randrange(60):02}"
    card = d(rng.choice([14, 15, 16, 16, 16, 18]))
    if luhn(card):
        card = card[:-1] + str((int(card[-1]) + 1) % 10)
    grouped = [card[i : i + 4] for i in range(0, len(card), 4)]
    return rng.choice([
        f"{year}-{month:02}-{day:02}", f"{year}-{month:02}-{day:02} {time}", f"{day:02}/{month:02}/{year} {time[:5]}", f"{day:02}.{month:02}.{year}",
        f"{year}{month:02}{day:02}{time.replace(':', '')}", f"{year}-{month:02}-{day:02} - {year + 1}-{month:02}-{day:02}", f"{time}:{d(2)}:{d(2)}:{d(2)}",
        f"{d(1)}.{d(2)}.{d(1)}-{year}{month:02}", f"v{d(1)}.{d(2)}.{d(4)}.{rng.randrange(256, 9999)}", f"{d(1)}.{d(1)}.{d(2)} ({year}-{month:02}-{day:02})",
        f"ORD-{year}-{d(6)}", f"#{d(rng.randrange(7, 13))}", d(rng.randrange(7, 15)), f"{d(4)}-{d(6)}", f"{d(3)}-{d(7)}-{d(7)}", f"{d(5)}/{year}-{d(4)}",
        f"978-{d(1)}-{d(2)}-{d(6)}-{d(1)}", f"{rng.randrange(1, 10)},{d(3)},{d(3)},{d(3)}", f"{rng.randrange(1, 10)}, {d(1)}, {d(2)}, {d(2)}",
        f"{d(1)}.{d(14)}", f"{d(2)}.{d(4)}, {d(2)}.{d(4)}", f"{year}-{year + 5}, {year + 7}-{year + 9}", f"{d(2)} {d(2)} {d(2)} {d(2)} {d(2)} {d(2)}",
        ":".join(f"{rng.randrange(256):02x}" for _ in range(6)), f"{d(2)} @ {d(1)}.{d(2)}", f"{d(1)} @ {d(2)} . {d(2)}", f"sold (at) {d(2)}.{d(2)}",
        card, rng.choice([" ", "-", ".", "/"]).join(grouped), f"{d(4)} {d(4)} {d(4)}", f"{d(3)} {d(3)} {d(3)} {d(3)}",
    ])


def _taught(text: str) -> list[tuple[list[float], float]]:
    """Candidates of a text, each as features and whether it is personal data.

    Where a base span stood, with what is written around it, stands a loose form of it or a look-alike: of the candidates
    that overlap it, the form itself counts. Other candidates count as none, but what is written like a loose form is left
    out, as nobody knows. Nor is there any that overlaps a base span, as it cannot be added.
    """
    base = base_spans(text)
    cover = _Cover(base)
    out = [(features(text, c), 0.0) for c in candidates(text) if cover.free(c[0], c[2]) and not _perhaps(text, c)]
    for start, kind, end in base:
        left, right = text[max(0, start - 100) : start], text[end : end + 100]
        rng = random.Random(f"{start} {text}")
        for version in range(VERSIONS):
            word = alike(rng) if version % 2 else loosened(rng, kind, text[start:end])
            told, at, to = f"{left}{word}{right}", len(left), len(left) + len(word)
            cover = _Cover(base_spans(told))
            for c in candidates(told):
                if c[0] < to and c[2] > at and cover.free(c[0], c[2]):
                    out.append((features(told, c), float(not version % 2 and c == (at, kind, to))))
    return out


def _perhaps(text: str, span: tuple[int, int, int]) -> bool:
    """Whether a candidate that no rule matches is written like personal data."""
    start, kind, end = span
    s = text[start:end]
    digits = sum("0" <= c <= "9" for c in s)
    if kind == 0:
        return _LAST.split(s)[-1].strip().isalpha()
    if kind == 1:
        return ":" in s or "," not in s
    if kind == 2:
        return 14 <= digits <= 19 and luhn("".join(c for c in s if "0" <= c <= "9"))
    said = {w.lower() for w in _WORD.findall(text[max(0, start - 40) : start])[-4:]}
    return 10 <= digits <= 15 and (s[0] in "+(" or s[:2] == "00" or bool(said & _CUES[3]))


def learn(docs: DataFrame, text: str = "text") -> Detector | None:
    """A detector fitted on the candidates of all documents; None if they show one class only.

    Base spans are written anew, as loose forms that count as personal data and as look-alikes that do not. Half of the
    documents, by hash, set the thresholds: the lowest chance from which on at least ``PRECISION`` of a kind's candidates are
    right. A kind that has no base spans is not added.

    Up to ``TOGETHER`` candidates come to the driver. More stay where they are: trees and thresholds are made of their sums.
    """
    part = docs.select(F.col(text).alias("t")).where("t is not null")

    def make():
        def work(texts):
            return {"x": [[[*x, y] for x, y in _taught(t)] for t in texts]}

        return work

    rows = map_rows(part, ["t"], "x array<array<double>>", make).select(F.xxhash64("t").alias("of"), F.explode("x").alias("x"))
    rows = saved(rows, "candidates")
    n = rows.count()
    if n > TOGETHER:
        return _learn_parts(rows, n)
    rows = rows.select("x", "of", F.xxhash64("x").alias("h")).orderBy("h", "of").toPandas()
    if not len(rows):
        return None
    x = np.array(rows["x"].tolist(), float)
    x, y = x[:, :-1], x[:, -1]
    fits = (rows["of"].to_numpy() & 1) == 0
    if not 0 < y[fits].sum() < fits.sum():
        return None
    trees = Trees(**SHAPE).fit(x[fits], y[fits])
    thresholds = []
    for kind in range(len(KINDS)):
        of = ~fits & (x[:, 0] == kind)
        p, good = trees.chance(x[of]), y[of]
        order = np.argsort(-p, kind="stable")
        right = np.cumsum(good[order]) / np.arange(1, len(order) + 1)
        enough = np.flatnonzero(right >= PRECISION)
        at = p[order][enough[-1]] if len(enough) else 2.0
        thresholds.append(max(0.5, float(at)))
    return Detector(trees, thresholds)


def _learn_parts(rows: DataFrame, n: int) -> Detector | None:
    """:func:`learn` from any number of candidates."""
    shape = Trees(**SHAPE)
    fits = F.col("of").bitwiseAND(F.lit(1)) == 0
    d = len(rows.first()["x"]) - 1
    shares = np.linspace(0, 1, shape.bins + 1)[1:-1].tolist()
    of = rows.where(fits)
    column = lambda j: F.element_at("x", j + 1)
    told = of.agg(F.count("*"), F.sum(column(d)), *(F.percentile_approx(column(j), shares, STEPS) for j in range(d))).first()
    if not told[0] or not 0 < told[1] < told[0]:
        return None
    cuts = [np.unique(c) for c in told[2:]]

    def block(batches):
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, d + 1)
            yield {"x": [coded(x, cuts).tobytes()], "y": [x[:, -1].tobytes()]}

    def arrays(row):
        y = np.frombuffer(row["y"])
        return np.frombuffer(row["x"], np.uint8).reshape(d, len(y)), y

    tasks = -(-n // TASK_ROWS)
    blocks = map_batches(of.select("x").coalesce(tasks), "x binary, y binary", block).rdd.map(arrays)
    blocks.persist(StorageLevel.MEMORY_AND_DISK)
    trees = shape.fit_parts(blocks, cuts)
    blocks.unpersist()
    shared = rows.sparkSession.sparkContext.broadcast(trees)

    def tally(batches):
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, d + 1)
            step = np.floor(shared.value.chance(x[:, :-1]) * STEPS).astype(int)
            yield {"kind": x[:, 0].astype(int), "step": step, "good": x[:, -1].astype(int)}

    marks = map_batches(rows.where(~fits).select("x"), "kind int, step int, good int", tally)
    marks = marks.groupBy("kind", "step").agg(F.count("*").alias("n"), F.sum("good").alias("good")).toPandas()
    thresholds = []
    for kind in range(len(KINDS)):
        of = marks[marks["kind"] == kind].sort_values("step", ascending=False)
        enough = np.flatnonzero((of["good"].cumsum() / of["n"].cumsum()).to_numpy() >= PRECISION)
        thresholds.append(max(0.5, float(of["step"].to_numpy()[enough[-1]]) / STEPS if len(enough) else 2.0))
    return Detector(trees, thresholds)


def _told(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span, or run of spans that overlap, replaced by the kind of its first in angle brackets."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind]}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def find(docs: DataFrame, text: str = "text", detector: Detector | None = None, redact: str | None = None) -> DataFrame:
    """Every row of ``docs`` with its personal data.

    New columns, which replace columns of the same names: ``n_email``, ``n_ip``, ``n_card``, ``n_phone`` (base spans),
    ``n_added`` (spans that the trees add), ``base`` and ``spans`` (base and all spans as ``kind:start:end`` in code points, by start, then kind, joined by
    commas), and the redacted text under the name ``redact`` if given (null stays null). Null and empty texts have no
    spans. Rows, copies too, are searched one by one; texts are searched whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast(detector)
    schema = "".join(f"n_{k} long, " for k in KINDS) + "n_added long, base string, spans string"

    def make():
        def work(texts):
            found = spans(texts, shared.value)
            out = {f"n_{k}": [sum(s[1] == i for s in base) for base, _ in found] for i, k in enumerate(KINDS)}
            out["n_added"] = [len(every) - len(base) for base, every in found]
            out |= {"base": [_told(b) for b, _ in found], "spans": [_told(e) for _, e in found]}
            if redact:
                out[redact] = [t and redacted(t, e) for t, (_, e) in zip(texts, found, strict=True)]
            return out

        return work

    return map_rows(docs, [text], schema + (f", {redact} string" if redact else ""), make)
