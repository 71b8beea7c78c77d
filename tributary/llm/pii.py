"""Personal data with offsets, also where it is disguised.

Base detectors run over the text as it is. Then transducers rewrite it, one after the other, each noting for what it emits
which stretch of the source it stands for: characters (look-alikes, entities and invisible marks become ASCII or vanish),
marks (bracketed at and dot signs, in four languages), addresses (worded or spaced signs, told by what is around them),
and numbers (spelled digits of four languages, doubled ones, worded dots and plus signs). The same detectors run over what
comes out, and their spans are mapped back to the source. Found spans that touch no base span of any kind are added, and
e-mail addresses that reach beyond one; base spans always stay. All of it takes time in proportion to the text.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.bpe import chunks
from tributary.llm.common import lean, text_bytes, to_python

KINDS = ("email", "ip", "card", "phone")

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# no match of these can start amid a run of digits, so none is tried there: long runs take linear time
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[str, int, int]


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @ and domain: the local part is the whole run of its characters before the @."""
    done = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start() and m.start() >= done:
            yield start, m.end()
            done = m.end()


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def detect(text: str) -> list[Span]:
    """Base spans by kind as listed, then start; matches that fail their test are dropped."""
    out: list[Span] = []
    if "@" in text:
        out += [("email", s, e) for s, e in emails(text)]
    if "." in text:
        out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


#: Letters of other scripts that look like ASCII letters.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S",
    "α": "a", "ο": "o", "ν": "v", "ρ": "p", "τ": "t", "υ": "u", "ι": "i", "κ": "k", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ı": "i", "İ": "I", "ⅼ": "l", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "․": ".", "。": ".", "＠": "@", "﹫": "@",
}
#: Marks that show nothing.
INVISIBLE = frozenset("­​‌‍⁠﻿")
#: Named entities of signs that personal data has.
ENTITIES = {"commat": "@", "period": ".", "lowbar": "_", "hyphen": "-", "dash": "-", "plus": "+", "num": "#", "lpar": "(", "rpar": ")"}
#: Names of the digits from 0 to 9 in English, French, German and Spanish.
DIGIT_NAMES = (
    "zero one two three four five six seven eight nine",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
)
#: Other names of digits.
MORE_NAMES = {"oh": 0, "une": 1, "ein": 1, "zwo": 2, "fuenf": 5}
#: Words by which the digit after them is repeated.
TIMES = {"double": 2, "doble": 2, "doppel": 2, "triple": 3}
#: Words for the signs of numbers and addresses.
PLUS_WORDS = ("plus", "más", "mas")
AT_WORDS = ("at", "ät", "arobase", "arobas", "arroba", "klammeraffe")
DOT_WORDS = ("dot", "point", "punkt", "punto")

DIGITS = {name: str(d) for names in DIGIT_NAMES for d, name in enumerate(names.split())} | {name: str(d) for name, d in MORE_NAMES.items()}


def _any(words) -> str:
    return "|".join(sorted(map(re.escape, words), key=len, reverse=True))


_ODD = re.compile(r"[^\x00-\x7f]")
_ENTITY = re.compile(rf"&(?:#([0-9]{{1,7}})|#[xX]([0-9a-fA-F]{{1,6}})|({_any(ENTITIES)}));")
# words of numbers stand alone; what may part two of them, or them and numerals
_SPOKEN = re.compile(rf"(?<![^\W_])(?:({_any(DIGITS)})|({_any(TIMES)})|({_any(PLUS_WORDS)}))(?![^\W_])", re.I)
_BETWEEN = re.compile(r"(?:[\x20.-]{1,2}[0-9]+)*[\x20.-]{1,2}")
_GAP = re.compile(r"[\x20-]{1,2}")
# a bracketed sign, which is then widened over the spaces around it
_BRACKETED = re.compile(rf"[\[({{<][\x20]*(?:({_any(AT_WORDS)}|@)|(?:{_any(DOT_WORDS)}|\.))[\x20]*[\])}}>]", re.I)
# any of these may stand for an @ or a dot of one address; words count only inside what ends like an address
_SIGN = re.compile(rf"@|(?<!\x20)\x20++(?:@(?=\x20)|(?i:{_any(AT_WORDS)})(?=\x20))")
_WORDED_DOT = re.compile(rf"(?<!\x20)\x20++(?i:{_any(DOT_WORDS)})\x20++")
_JOINT = re.compile(rf"\.|\x20++(?:(?i:{_any(DOT_WORDS)})|\.)\x20++")
_LABEL = re.compile(r"[A-Za-z0-9-]++")
_LOCAL_DOT = re.compile(rf"[A-Za-z0-9._%+-](\x20{{1,9}}(?i:{_any(DOT_WORDS)})\x20{{1,9}})\Z")
#: Endings of domains that a fully worded address may have whatever comes before them.
_ENDINGS = frozenset("com org net edu gov info io de fr es uk eu us co".split())
#: More endings that a fully worded address may have: countries, and common others.
_MORE_ENDINGS = frozenset("""
ac ad ae af ag ai al am ao aq ar as at au aw ax az ba bb bd be bf bg bh bi bj bm bn bo br bs bt bw by bz ca cc cd cf cg ch ci ck cl cm cn cr cu cv cw cx cy cz dj dk
dm do dz ec ee eg er et fi fj fk fm fo ga gd ge gf gg gh gi gl gm gn gp gq gr gs gt gu gw gy hk hm hn hr ht hu id ie il im in iq ir is it je jm jo jp ke kg kh ki km kn
kp kr kw ky kz la lb lc li lk lr ls lt lu lv ly ma mc md me mg mh mk ml mm mn mo mp mq mr ms mt mu mv mw mx my mz na nc ne nf ng ni nl no np nr nu nz om pa pe pf pg ph
pk pl pm pn pr ps pt pw py qa re ro rs ru rw sa sb sc sd se sg sh si sj sk sl sm sn so sr ss st su sv sx sy sz tc td tf tg th tj tk tl tm tn to tr tt tv tw tz ua ug uy
uz va vc ve vg vi vn vu wf ws ye yt za zm zw
academy aero agency app art arpa asia band bank berlin bike biz blog build business cafe cam capital care cat center chat church city clinic cloud club codes coffee
community company computer consulting coop cricket dev digital direct directory earth education email energy engineering events example expert exchange farm finance
fitness foundation fun fund fyi games gallery global green group guide guru health hospital host hotel house institute insure international int invalid invest jobs
kitchen law legal life link live loan local localhost london ltd management market marketing media mil mobi museum name network news ngo nyc one online ong page paris partners parts
photo photography photos pics post press pro productions pub red rent report review reviews rocks run school science services shop site social software solar solutions
space sport store stream studio support systems team tech technology tel test tips today tokyo tools top trade training travel university vip vision watch website wedding
wiki win work works world xxx xyz zone
""".split())
#: Words that, before a worded dot, make prose of it: "look at the dot in the middle".
_PROSE = frozenset("the a an this that these those each every any some one another my your his her its our their which what no either neither".split())
_NUMBER_BEFORE = re.compile(rf"(?:[0-9]|(?<![^\W_])(?:{_any(DIGITS)}))\Z", re.I)
_NUMBER_AFTER = re.compile(rf"[0-9]|(?:{_any(DIGITS)}|{_any(TIMES)})(?![^\W_])", re.I)
# what any disguise without odd characters has one of; looked for in the lower-cased text after a space
_PAIR = re.compile(rf"[\W_](?:{_any([*DIGITS, *TIMES])})(?:[\x20.-]{{1,2}}[0-9]++)*+[\x20.-]{{1,2}}(?:{_any(DIGITS)})(?![^\W_])")
_MARK = re.compile(_BRACKETED.pattern)
_SPACED = (*[f" {w} " for w in (*DOT_WORDS, *AT_WORDS) if w != "at"], " @ ")  # an "at" needs a dot of another form, too
_LOOSE = re.compile(r"@[a-z0-9-]+\x20+\.\x20")


class Tape:
    """A text that has been rewritten: `cuts` (lo, hi, start, end) say that text[lo:hi] stands for source[start:end]; all between stands for itself.

    A rewritten stretch has one character or none until the last transducer has run, so no later one begins or ends inside it.
    """

    def __init__(self, text: str) -> None:
        self.text = text
        self.cuts: list[tuple[int, int, int, int]] = []
        self.lows: list[int] = []

    def source(self, lo: int, hi: int) -> tuple[int, int]:
        """The stretch of the source that text[lo:hi] stands for; it must not be empty."""
        return self._at(lo)[0], self._at(hi - 1)[1]

    def _at(self, i: int) -> tuple[int, int]:
        k = bisect_right(self.lows, i) - 1
        if k < 0:
            return i, i + 1
        _, hi, start, end = self.cuts[k]
        return (start, end) if i < hi else (end + i - hi, end + i - hi + 1)

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replaces stretches (lo, hi, new), which come in order and apart from each other."""
        old, cuts, text, at, size, k = self.cuts, [], [], 0, 0, 0
        for lo, hi, new in [*edits, (len(self.text), len(self.text), None)]:
            while k < len(old) and old[k][1] <= lo:
                cuts.append((old[k][0] + size - at, old[k][1] + size - at, *old[k][2:]))
                k += 1
            text.append(self.text[at:lo])
            size += lo - at
            if new is None:
                break
            cuts.append((size, size + len(new), *self.source(lo, hi)))
            text.append(new)
            size, at = size + len(new), hi
            while k < len(old) and old[k][0] < hi:
                k += 1
        self.text, self.cuts, self.lows = "".join(text), cuts, [c[0] for c in cuts]


@cache
def _look(c: str) -> str:
    if c in INVISIBLE:
        return ""
    if c in LOOKALIKES:
        return LOOKALIKES[c]
    plain = unicodedata.normalize("NFKC", c)
    return plain if len(plain) == 1 and plain.isascii() and plain.isprintable() and not plain.isspace() else c


def _ends(labels: list[str], joints: list[str], sign: str, plain_name: bool) -> bool:
    """Whether labels, parted by "." (plain), "[" (was bracketed), "w" (worded) or "s" (spaced), are a domain after a sign: "@", " @ ", "at" or a word for nothing but "@"."""
    last = labels[-1].lower()
    if not (len(last) > 1 and last.isalpha() or last.startswith("xn--")):
        return False
    if "s" in joints or sign == " @ ":
        return last in _ENDINGS and labels[-1] == last and ("s" not in joints or "." not in joints)
    signed = sign != "at"
    if signed and (joints[-1] != "w" or "w" * len(joints) == "".join(joints)):
        return True
    if not signed and "[" in joints:
        return True
    if not signed and "w" not in joints:
        return False  # "a talk at example.com"
    if last in _ENDINGS or last.startswith("xn--") or not signed and (joints.count("w") > 1 or not plain_name):
        return True
    return last in _MORE_ENDINGS and labels[-2].lower() not in _PROSE


def characters(text: str) -> list[tuple[int, int, str]]:
    edits = [(m.start(), m.end(), new) for m in _ODD.finditer(text) if (new := _look(m[0])) != m[0]]
    if "&" in text:
        for m in _ENTITY.finditer(text):
            point = int(m[1]) if m[1] else int(m[2], 16) if m[2] else ord(ENTITIES[m[3]])
            if 32 < point < 127:
                edits.append((m.start(), m.end(), chr(point)))
        edits.sort()
    return edits


def marks(text: str) -> list[tuple[int, int, str]]:
    """Bracketed signs, with the spaces around them."""
    edits, done = [], 0
    for m in _BRACKETED.finditer(text):
        lo, hi = m.span()
        while lo > done and text[lo - 1] == " ":
            lo -= 1
        while hi < len(text) and text[hi] == " ":
            hi += 1
        edits.append((lo, hi, "@" if m[1] else "."))
        done = hi
    return edits


def addresses(tape: Tape) -> list[tuple[int, int, str]]:
    """Edits that make @ and "." of what stands for them in addresses; brackets are gone from the tape, but its cuts tell where they were."""
    text, edits, done = tape.text, [], 0
    for m in _SIGN.finditer(text):
        start = m.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if m.start() < done or start == m.start():
            continue
        word = m[0].strip().lower()
        sign = "@" if m[0] == "@" or word not in ("@", "at") else " @ " if word == "@" else "at"
        at = m.end()
        while m[0] != "@" and text[at : at + 1] == " ":
            at += 1
        place, labels, joints, dots, fit, end = (m.start(), at), [], [], [], 0, 0
        while label := _LABEL.match(text, at):
            labels.append(label[0])
            at = label.end()
            if joints and _ends(labels, joints, sign, text[start : m.start()].isalpha()):
                fit, end = len(joints), at
            if not (joint := _JOINT.match(text, at)) or sign == "at" and joint[0].strip().lower() not in (".", "dot"):
                break  # "at boiling point in"
            dots.append(joint.span())
            if joint[0] == ".":
                s, e = tape.source(at, at + 1)
                joints.append("[" if e - s > 1 else ".")
            else:
                joints.append("s" if joint[0].strip() == "." else "w")
            at = joint.end()
        if not fit:
            continue
        before = []
        while joint := _LOCAL_DOT.search(text, max(done, start - 26), start):
            lo = joint.start(1)
            while lo > done and text[lo - 1] in _LOCAL:
                lo -= 1
            if text[lo : joint.start(1)].lower() in _PROSE:
                break
            before.append((*joint.span(1), "."))
            start = lo
        edits += before[::-1]
        if m[0] != "@":
            edits.append((*place, "@"))
        edits += [(*span, ".") for span, kind in zip(dots[:fit], joints[:fit], strict=True) if kind in "ws"]
        done = end
    return edits


def worded_dots(text: str) -> list[tuple[int, int, str]]:
    """Dots between numbers, as of an IP address."""
    return [(m.start(), m.end(), ".") for m in _WORDED_DOT.finditer(text) if _NUMBER_BEFORE.search(text, max(0, m.start() - 8), m.start()) and _NUMBER_AFTER.match(text, m.end())]


def numbers(text: str) -> list[tuple[int, int, str]]:
    """Runs of two spelled digits or more, with numerals among them, as numerals; a word for plus before a run is its sign.

    An automaton over the words of numbers: outside, or in a run, which goes on as long as nothing but gaps and numerals
    part it from the next word. What parts two spelled digits, if it is but a gap, goes with the first.
    """
    edits: list[tuple[int, int, str]] = []
    run: list[re.Match] = []
    previous = 0  # where the last word ended

    def close() -> None:
        words = list(run)
        while words and not words[-1][1]:
            words.pop()  # nothing comes after a "double" or a "plus"
        while len(words) > 1 and words[0][3] and words[1][3]:
            words.pop(0)
        inside = [w for w in words if not w[3]]
        if sum(1 for w in inside if w[1]) + sum(1 for w in inside if w[2]) < 2:
            return
        times = 1
        lo = None
        for k, w in enumerate(words):
            if w[3]:
                if k == 0 and _GAP.fullmatch(text, w.end(), words[1].start()):
                    edits.append((w.start(), words[1].start(), "+"))
            elif w[2]:
                times, lo = TIMES[w[2].lower()], w.start()
            else:
                hi = w.end()
                if k + 1 < len(words) and _GAP.fullmatch(text, hi, words[k + 1].start()):
                    hi = words[k + 1].start()
                edits.append((w.start() if lo is None else lo, hi, DIGITS[w[1].lower()] * times))
                times, lo = 1, None

    for m in _SPOKEN.finditer(text):
        goes_on = run and not m[3] and _BETWEEN.fullmatch(text, previous, m.start())
        if goes_on and run[-1][2] and not (m[1] and _GAP.fullmatch(text, previous, m.start())):
            run.pop()  # a "double" that has no digit right after it
            goes_on = False
        if not goes_on:
            close()
            run = []
        run.append(m)
        previous = m.end()
    close()
    return edits


def normalise(text: str) -> Tape | None:
    """The text with its disguises undone, or None if no transducer would change it."""
    tape = Tape(text)
    if edits := characters(text):
        tape.rewrite(edits)
    if not edits:
        low = " " + text.lower()
        if not (any(s in low for s in _SPACED) or _MARK.search(low) or "@" in low and _LOOSE.search(low) or _PAIR.search(low)):
            return None
    if edits := marks(tape.text):
        tape.rewrite(edits)
    if edits := addresses(tape):
        tape.rewrite(edits)
    if edits := worded_dots(tape.text):
        tape.rewrite(edits)
    if edits := numbers(tape.text):
        tape.rewrite(edits)
    return tape


def find(text: str) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans), each by kind as listed and then start; offsets in code points, end exclusive."""
    base = detect(text)
    tape = normalise(text)
    if tape is None:
        return base, base
    of = {k: [(s, e) for kind, s, e in base if kind == k] for k in KINDS}
    ends = {k: [e for _, e in spans] for k, spans in of.items()}

    def met(s: int, e: int) -> Iterator[Span]:
        for k, spans in of.items():
            i = bisect_right(ends[k], s)
            while i < len(spans) and spans[i][0] < e:
                yield (k, *spans[i])
                i += 1

    more: list[Span] = []
    for kind, lo, hi in detect(tape.text):
        s, e = tape.source(lo, hi)
        own = list(met(s, e))
        # an address of which the base has but the part after a look-alike counts as a whole, too
        if not own or kind == "email" and all(k == kind and s <= x and y <= e and (x, y) != (s, e) for k, x, y in own):
            more.append((kind, s, e))
    if not more:
        return base, base
    return base, sorted([*base, *more], key=lambda x: (KINDS.index(x[0]), x[1]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        at = 0
        for run in chunks(b["text"].to_pylist()):
            found = [find(t.decode("utf-8", "replace")) for t in run]
            count = {k: pa.array([sum(x[0] == k for x in spans) for _, spans in found], pa.int64()) for k in KINDS}
            yield pa.record_batch(
                {"doc_id": b["doc_id"].slice(at, len(run))} | {f"n_{k}": v for k, v in count.items()}
                | {"base_sha256": pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found], pa.string()), "spans": pa.array([joined(spans) for _, spans in found], pa.string())}
            )
            at += len(run)


def find_pii(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, n_email, n_ip, n_card, n_phone (of all spans), base_sha256, spans.

    A null text is empty: no spans, the hash of the empty string. Spans of different kinds may overlap, as base detectors
    run by kind. Repeated rows are read one by one, texts whole, however long. An empty table gives an empty result. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
    return to_python(rows).mapInArrow(lean(_found), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
