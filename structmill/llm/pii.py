"""Personal data in whole texts: fixed patterns, and a linear-chain CRF over word shapes beside them.

The CRF is trained here on the exact likelihood, from the small table ``LABELLED``
with its slots filled by seeded random values, and decoded by Viterbi in numpy
batches over every word of every text.  What a label gains at a word is a sum over
the word and its neighbours of what each alone tells (shape, length, digits, and
itself if it is a word of the table), so each distinct word is looked at once.  Chains
are pieces of ``CORE`` words, decoded with ``EDGE`` words more on both sides.  The CRF
adds spans that overlap none of the patterns' spans.

Kinds in order: email, ip, card, phone, secret, id, address, name (the last four the
CRF's alone).  Positions are code points, end exclusive.  Defined cases: null text is
empty and has no spans; repeated rows are each searched; null ids pass through.
Memory is a few hundred bytes a word of a slice of texts (``SLICE`` bytes, or one
longer text, of which ``CHAINS`` chains are decoded at once) and what ``KNOWN``
distinct words tell.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from structmill.llm import words as W
from structmill.llm.shared import short_batches

KINDS = ("email", "ip", "card", "phone", "secret", "id", "address", "name")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
#: The training table: texts with {slots}; a slot of a kind's name is a span, ``plain`` a word of no kind, ``prose`` some sentences.
LABELLED = """
write to {email} before noon
my address is {email} thanks
contact {email}, or the {plain}
send it to {email} by {number} pm
mail {email} and wait
email: {email}
reach {email} or {email} instead
the {plain} of {email} was late
{email} wrote to {email} about {plain}
the host {ip} did not answer
from {ip} to {ip} in {number} ms
login at {ip} failed {number} times
the node {ip} was up at 10:45
peer {ip} left on 2021-03-04
address {ip} is down
server: {ip}
card {card} was charged {number}.00
pay with {card} today
the number {card} expired 05/24
visa {card} for order {number}
debit card {card} on file
credit card number: {card}
call {phone} after six
reach me on {phone} or by post
phone {phone} for {number} tickets
my cell is {phone} ok
tel: {phone} ext 12
fax {phone} room 4
dial {phone} free of charge
please dial {phone} today
please call {phone} now
text me at {phone} tonight
phone number {phone}
ring {phone} and ask for {plain}
token = {secret} end
token: {secret}
api_key: {secret} keep
api key = {secret}
secret = {secret} rotated
secret {secret} leaked
password: {secret} changed
the password is {secret} now
passwd={secret}
pwd: {secret}
password {secret}
key {secret} leaked
access key: {secret}
bearer {secret}
token {secret} {plain}
{plain} {hash} {plain}
commit the {hash} to {plain}
ssn {id} on the form
ssn: {id}
social security number {id}
passport {id} was lost
passport number: {id}
tax id {id} for {plain}
id number {id}
national id: {id} ok
licence no {id}
he lives at {address} in {plain}
she lives at {address} now
deliver to {address} by {plain}
my home is {address}
street address: {address}
ship it to {address}, please
moved to {address} last year
my name is {name} and i {plain}
my name is {name}.
signed, {name}
regards, {name}
dear {name}, the {plain}
mr {name} said
mrs {name} was there
dr {name} will see you
name: {name}
the file has {number} rows and {number} columns
in {number} they sold {number} units for 19.95 each
in 1998 they sold 2,340 units
version 4.0 came after 3.11.2 and 2.7
licensed under CC BY-NC 4.0 or later
see section 2.3.1 on page {number}
chapter 12 of volume 3, lines 5-17
at 10:45 on 2021-03-04 the train left
covid-19 and g8 and mp3 and h2o
it grew by 35% from 1,204,556 to 1,630,000
order {number} and ticket {number} are open
the 3rd of 5 and the 21st of 40
temperatures of -12 to 25 degrees
follow @someone and @other5 there
about 100000 people, 1/3 of them {plain}
row {number} | col {number} | {number} | {number} | {number}
item 12$$$ and 34### or 56%%% out of 78&&&
size 1920x1080 at 60 fps
isbn 978 and sku 00017 in box {number}
scores 3-2, 1-0 and 15-7 in {number}
{plain} {plain} at {plain} {plain} in {plain} {plain}
{plain} {plain} {plain}, {plain} the {plain} of {plain}
The {plain} Of {plain} {plain}. And {plain}
{plain} {number} {plain} {number} {plain}
{number} {number} {number} {number}
the {plain} is {plain} and to {plain} by {plain}
a dot on the {plain} at {plain}
this is the key to {plain} and a token of {plain}
the secret of {plain} is {plain}
a password is {plain} to {plain}
the street is {plain} and {plain} avenue was {plain}
my name was {plain} in {plain}
call the {plain} or phone the {plain} today
{plain} was at {number} {plain} in {number}
https://{plain}.example.com/{plain}/{number}?x={number}
see http://{plain}.org/{plain} and www.{plain}.net
{plain}: {plain} = {plain}; {plain}
{PLAIN} {PLAIN} {PLAIN} {plain}
{Plain} {Plain} {plain} {Plain}.
{Plain} {plain} {plain}, {plain} {plain}
released under the MIT License. {prose}
token = {secret} {prose}
{prose} write to {email} {prose}
{prose} password: {secret} {prose}
{plain} the password: {secret} and {plain}
{plain} {plain} pwd: {secret} {plain} {plain}
{prose} secret: {secret} and {prose}
{number} {number} password: {secret} {number}
{prose} call {phone} {prose}
{prose}
{prose} {number} {prose}
{prose} {prose}
{prose}, {prose}
{prose} {prose} {prose}
{prose} {prose} {prose} {prose}
{prose}
{prose} {prose}
{prose} {prose} {prose}
{prose} {prose} {prose}
{prose} {Plain}. {Plain} {plain} {prose}
{prose} the. {Plain} {plain}, {prose}
{plain} is. {Plain} {plain} {plain}. {Plain}. {prose}
{plain}. {Plain} {plain}. {Plain} {Plain} {plain}.
{plain} the {plain} with. {Plain}. The {plain}
{Plain}, {plain}. {Plain}. {Plain} {Plain}, the {plain}
{run}
{run} {prose}
{prose} {run} {prose}
{run} {run}
{prose} {run}
""".strip().split("\n")
#: Lines that each line of the table gives, with slots filled anew.
FILLED = 6

_HEXES, _LETTERS, _ALNUM = "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


def _filling(kind: str, rng: np.random.Generator) -> str:
    """A random value of a slot."""
    of = lambda letters, a, b: "".join(rng.choice(list(letters), rng.integers(a, b + 1)))
    digits = lambda n: of("0123456789", n, n)
    any_of = lambda *forms: forms[rng.integers(len(forms))]()
    plain = lambda: of(_LETTERS, 2, 9)
    title = lambda: plain().capitalize()
    if kind == "email":
        user = any_of(plain, lambda: f"{plain()}.{plain()}", lambda: plain() + digits(2))
        return any_of(lambda: f"{user}@{plain()}.example.org", lambda: f"{user} at {plain()} dot org", lambda: f"{user} [at] {plain()} [dot] com", lambda: f"{user}(at){plain()}.net", lambda: f"{user} at {plain()} dot com", lambda: f"{user}@{plain()}.com")
    if kind == "ip":
        return any_of(lambda: ".".join(str(x) for x in rng.integers(1, 255, 4)), lambda: f"fe80::{of(_HEXES, 3, 4)}:{of(_HEXES, 2, 4)}", lambda: f"2001:db8::{of(_HEXES, 4, 4)}:{of(_HEXES, 3, 4)}", lambda: ".".join(str(x) for x in rng.integers(1, 255, 4)) + ":80")
    if kind == "card":
        join = rng.choice([" ", "-", ""])
        return join.join(digits(4) for _ in range(4))
    if kind == "phone":
        return any_of(lambda: f"+1 ({digits(3)}) {digits(3)}-{digits(4)}", lambda: f"+44 {digits(2)} {digits(4)} {digits(4)}", lambda: f"({digits(3)}) {digits(3)}-{digits(4)}", lambda: f"{digits(3)}-{digits(3)}-{digits(4)}", lambda: f"{digits(3)} {digits(4)}", lambda: f"1-800-{digits(3)}-{digits(4)}", lambda: f"{digits(3)}-{digits(4)}", lambda: f"{digits(3)}.{digits(3)}.{digits(4)}", lambda: f"+{digits(11)}")
    if kind == "secret":
        return any_of(lambda: of(_HEXES, 32, 40), lambda: f'"{of(_HEXES, 32, 40)}"', lambda: "ghp_" + of(_ALNUM, 36, 36), lambda: "sk_live_" + of(_ALNUM, 20, 24), lambda: "AKIA" + of("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 16, 16), lambda: f"'{of(_ALNUM, 20, 30)}'", lambda: plain() + plain(), lambda: plain() + digits(2), lambda: of(_ALNUM, 8, 12), lambda: plain() + "!" + digits(3))
    if kind == "hash":
        return any_of(lambda: of(_HEXES, 32, 40), lambda: "ghp_" + of(_ALNUM, 36, 36), lambda: "AKIA" + of("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 16, 16), lambda: "sk_live_" + of(_ALNUM, 20, 24))
    if kind == "id":
        return any_of(lambda: f"{digits(3)}-{digits(2)}-{digits(4)}", lambda: of("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1, 2) + digits(7), lambda: digits(9), lambda: f"{digits(3)} {digits(2)} {digits(4)}")
    if kind == "address":
        road = rng.choice(["Street", "St", "Avenue", "Ave", "Road", "Rd", "Lane", "Drive"])
        return any_of(lambda: f"{digits(rng.integers(1, 5))} {title()} {road}", lambda: f"{digits(2)} {title()} {title()} {road}", lambda: f"{digits(3)} {rng.choice(['N', 'S', 'W', 'E'])} {title()} {road}")
    if kind == "name":
        return any_of(lambda: f"{title()} {title()}", lambda: f"{title()} {title()[0]}. {title()}", title)
    if kind == "number":
        return digits(rng.integers(1, 8)).lstrip("0") or "7"
    if kind == "run":  # one word again and again
        word = any_of(title, plain, lambda: of(_LETTERS, 1, 3), lambda: of(_LETTERS, 8, 22), lambda: of(_LETTERS, 1, 2).title(), lambda: of(_LETTERS, 8, 16).title(), lambda: plain() + "," + plain(), lambda: plain() + ".")
        return " ".join([word] * int(rng.integers(4, 26)))
    if kind == "prose":
        form = rng.integers(8)
        words = [sorted(_cues())[rng.integers(len(_cues()))] if rng.random() < 0.35 else plain() for _ in range(rng.integers(3, 9))]
        if form == 1:
            return "!! ".join(words).upper() + "!!"
        words = [w.capitalize() if rng.random() < 0.3 else w for w in words]
        marks = [rng.choice([".", ",", ".\n"], p=[0.6, 0.2, 0.2]) if rng.random() < 0.25 else "" for _ in words]
        return " ".join(w + m for w, m in zip(words, marks)) + "."
    return {"plain": plain, "Plain": title, "PLAIN": lambda: plain().upper()}[kind]()


def filled(line: str, rng: np.random.Generator) -> tuple[str, list[tuple[int, int, int]]]:
    """A line of the table with its slots filled, and the spans in it."""
    text, spans, at = "", [], 0
    for m in re.finditer(r"\{(\w+)\}", line):
        text += line[at : m.start()]
        value = _filling(m[1], rng)
        kind = "secret" if m[1] == "hash" else m[1]
        if kind in KINDS:
            spans.append((KINDS.index(kind), len(text), len(text) + len(value)))
        text += value
        at = m.end()
    return text + line[at:], spans


BUCKETS = 1 << 13
#: Words of a chain, and words on both sides that it is decoded with.
CORE, EDGE = 64, 12
#: Words of a span at most.
MOST_WORDS = 12
#: Neighbours that tell something about a word, itself first.
OFFSETS = (0, -1, -2, 1, 2)
#: Distinct words that a task keeps what they tell of.
KNOWN = 100_000
#: Bytes of texts that are searched at once, and chains decoded at once.
SLICE, CHAINS = 1 << 19, 1536
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_HEX = re.compile(r"[\"'`]?[0-9a-fA-F]{24,}[\"'`]?\W*")
_COUNTS = (*(f"n_{k}" for k in KINDS[:4]), "n_added")
_DIGIT = np.zeros(256, bool)
_DIGIT[[64, *range(48, 58)]] = True


def _luhn(digits: str) -> bool:
    odd = [int(x) for x in digits[-1::-2]]
    even = [2 * int(x) for x in digits[-2::-2]]
    return (sum(odd) + sum(x - 9 if x > 9 else x for x in even)) % 10 == 0


def patterns(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns' matches, in order; failing matches are dropped without a retry."""
    out, last = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((0, start, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and _luhn(digits):
                out.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((3, *m.span()))
    return sorted(out)


class _Classes(dict):
    """Code point to its sign in a shape; all beyond ASCII are like a small letter."""

    def __missing__(self, c):
        return c if c < 128 else 97


_CLASS = _Classes({c: 57 for c in range(48, 58)} | {c: 65 for c in range(65, 91)} | {c: 97 for c in range(97, 123)})
_SAME, _NUMBER = re.compile(r"(.)\1+"), re.compile(r"[0-9]+")
_KEYED = re.compile(r"\w*(?:pass|pwd|token|key|secret)\w*[=:]\S{6}", re.I)


def _shape(word: str) -> str:
    return _SAME.sub(r"\1", word[:64].translate(_CLASS))[:24]


def _bare(word: str) -> str:
    return word[:40].lower().strip("\"'.,:;()[]=!?")


@cache
def _cues() -> frozenset[str]:
    """The table's own words; others are known by their shapes only."""
    return frozenset(_bare(w) for line in LABELLED for w in re.sub(r"\{\w+\}", " ", line).split()) | {"at", "dot", "street", "st", "avenue", "ave", "road", "rd", "lane", "drive"}


def features(word: str) -> list[list[int]]:
    """Hashed features that a word gives to the word at each of ``OFFSETS`` from which it is seen."""
    shape, bare = _shape(word), _bare(word)
    cue = bare if bare in _cues() else "?"
    full = word[:64].translate(_CLASS)
    digits, lower, upper = full.count("9"), full.count("a"), full.count("A")
    groups = "".join(str(min(len(x), 9)) for x in _NUMBER.findall(word[:64])) if digits else ""
    mixed = f"{min(digits, 4)}{min(lower, 2)}{min(upper, 2)}"
    last = word[-1:] if word[-1:] in _ENDS else "a"
    own = [f"s={shape}", f"w={cue}", f"l={min(len(word) // 4, 10)}", f"d={min(digits, 20)}", f"g={groups}", f"m={mixed}", f"lm={min(len(word) // 8, 4)}{mixed}", f"e={last}"]
    own += ["hex"] * bool(len(word) > 23 and _HEX.fullmatch(word)) + ["at"] * ("@" in word[1:-1]) + [f"pre={word[:4]}"] * (word[:4] in ("ghp_", "sk_l", "AKIA")) + ["kv"] * bool(_KEYED.match(word[:64]))
    end = last if last != "a" else ""
    short = _OTHER.sub("-", shape)[:8]
    near = [f"w={cue}", f"s={short}", f"w={cue}{end}", f"end={end}"]
    return [[zlib.crc32(f"{o}{x}".encode()) % BUCKETS for x in (["bias", *own] if o == 0 else near)] for o in OFFSETS]


_ENDS, _OTHER = frozenset(".,;:!?=\"')"), re.compile(r"[^9Aa@]+")


def alike(h: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A key of each word; words of letters only (none inside, one or two equal marks after them) that are not of the table share one if they have the same features."""
    upper = (data >= 65) & (data <= 90)
    letter = upper | ((data >= 97) & (data <= 122)) | (data >= 128)
    count = lambda mask, a, b: (c := np.append(0, np.cumsum(mask, dtype=np.int32)))[b] - c[a]
    letters, uppers, points = count(letter, start, end), count(upper, start, end), count((data & 0xC0) != 0x80, start, end)
    marks = end - start - letters
    last, head = data[end - 1], upper[start]
    ok = (marks <= 2) & (letters > 0) & (points < 24) & ((uppers == 0) | (uppers == head) | (uppers == letters))
    ok &= (marks == 0) | np.isin(last, np.frombuffer(b".,;:!?", np.uint8)) & ~letter[end - 1] & ((marks == 1) | (data[np.maximum(end - 2, start)] == last))
    at = np.flatnonzero(ok)
    bare = W.hashes(data, start[at], end[at] - marks[at], True)
    at = at[~np.isin(bare, _cue_hashes())]
    lower = letters - uppers
    code = np.zeros(len(at), np.uint64)
    for value in (points[at], np.minimum(lower[at], 2), np.minimum(uppers[at], 2), head[at], np.where(marks[at] > 0, last[at], 0)):
        code = code * np.uint64(256) + value.astype(np.uint64)
    out = h.copy()
    out[at] = W.mix(code, 801)
    return out


@cache
def _cue_hashes() -> np.ndarray:
    data, offsets = W.buffers(pa.array(sorted(_cues())))
    full = np.flatnonzero(np.diff(offsets))
    return W.hashes(data, offsets[:-1][full], offsets[1:][full], True)


def _labels(text: str, spans) -> tuple[list[str], list[int]]:
    """Words of a text, and the label of each."""
    words, labels = [], []
    for m in _WORD.finditer(text):
        words.append(m[0])
        inside = [(k, a) for k, a, b in spans if a < m.end() and m.start() < b]
        labels.append(0 if not inside else 1 + 2 * inside[0][0] + (m.start() > inside[0][1]))
    return words, labels


_ALLOWED = np.array([[not b.startswith("I") or a[2:] == b[2:] for b in LABELS] for a in LABELS])


def _log_sum(x, axis):
    top = x.max(axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis, keepdims=True)) + top).squeeze(axis)


def _slots() -> int:
    return sum(16 if o == 0 else 4 for o in OFFSETS)


def _padded(words: list[str], size: int) -> np.ndarray:
    """Feature ids (size, slots) of the words among their neighbours; BUCKETS stands for none."""
    told = [features(w) for w in words]
    out = np.full((size, _slots()), BUCKETS, np.int32)
    for i in range(len(words)):
        mine = [x for o, at in enumerate(OFFSETS) if 0 <= i + at < len(words) for x in told[i + at][o]]
        out[i, : len(mine)] = mine
    return out


def likelihood(e: np.ndarray, move: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a batch of chains with gains e (chain, word, label): log of the sum over all paths, and the chance of each label and, summed over the batch, of each pair (O before and after)."""
    many, n, k = e.shape
    forward, backward = np.empty_like(e), np.empty_like(e)
    forward[:, 0] = move[0] + e[:, 0]
    for i in range(1, n):
        forward[:, i] = _log_sum(forward[:, i - 1, :, None] + move, 1) + e[:, i]
    last = np.arange(n) == sizes[:, None] - 1
    backward[:, -1] = move[:, 0]
    for i in range(n - 2, -1, -1):
        backward[:, i] = np.where(last[:, i, None], move[:, 0], _log_sum(move + (e[:, i + 1] + backward[:, i + 1])[:, None, :], 2))
    z = _log_sum(forward[np.arange(many), sizes - 1] + move[:, 0], 1)
    live = np.arange(n) < sizes[:, None]
    chance = np.where(live[:, :, None], np.exp(np.minimum(forward + backward - z[:, None, None], 0)), 0)
    pairs = np.zeros((k, k))
    pairs[0] += chance[:, 0].sum(0)
    pairs[:, 0] += chance[np.arange(many), sizes - 1].sum(0)
    for i in range(1, n):
        both = forward[:, i - 1, :, None] + move + (e[:, i] + backward[:, i])[:, None, :] - z[:, None, None]
        pairs += np.exp(np.minimum(both[live[:, i]], 0)).sum(0)
    return z, chance, pairs


@cache
def train(epochs: int = 9, rate: float = 0.4, decay: float = 2e-3, batch: int = 48, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Weights of features by label (the last row is of no feature), and of label pairs (O before and after each chain), by AdaGrad."""
    rng = np.random.default_rng(seed)
    lines = [_labels(*filled(line, rng)) for line in LABELLED for _ in range(FILLED)]
    longest, k = max(len(w) for w, _ in lines), len(LABELS)
    ids = np.stack([_padded(w, longest) for w, _ in lines])
    sizes = np.array([len(w) for w, _ in lines])
    gold = np.zeros((len(lines), longest), np.int64)
    for i, (_, labels) in enumerate(lines):
        gold[i, : len(labels)] = labels
    emit, move = np.zeros((BUCKETS + 1, k)), np.where(_ALLOWED, 0.0, -1e4)
    emit_squares, move_squares = np.full((BUCKETS + 1, k), 1e-2), np.full((k, k), 1e-2)
    for _ in range(epochs):
        order = rng.permutation(len(lines))
        for lo in range(0, len(order), batch):
            at = order[lo : lo + batch]
            n = int(sizes[at].max())
            found, size, labels = ids[at, :n], sizes[at], gold[at, :n]
            _, chance, pairs = likelihood(emit[found].sum(2), move, size)
            live = np.arange(n) < size[:, None]
            i, t = np.nonzero(live)
            chance[i, t, labels[i, t]] -= 1
            before = np.append(np.zeros((len(at), 1), int), labels[:, :-1], 1)
            np.subtract.at(pairs, (before[i, t], labels[i, t]), 1)
            np.subtract.at(pairs, (labels[np.arange(len(at)), size - 1], 0), 1)
            pairs = np.where(_ALLOWED, pairs + decay * move, 0)
            move_squares += pairs**2
            move -= rate * pairs / np.sqrt(move_squares)
            ids_of, gains = found[i, t].ravel(), chance[i, t]
            step = np.stack([np.bincount(ids_of, np.repeat(gains[:, y], found.shape[2]), BUCKETS + 1) for y in range(k)], 1)
            step[-1] = 0
            step += decay * emit * (step != 0)
            emit_squares += step**2
            emit -= rate * step / np.sqrt(emit_squares)
    return emit.astype(np.float32), move.astype(np.float32)


def viterbi(e: np.ndarray, move: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The best labels of each chain of gains e (chain, word, label), 0 beyond its size."""
    many, n, k = e.shape
    e = np.ascontiguousarray(e.transpose(1, 2, 0))  # (word, label, chain)
    best = move[0][:, None] + e[0]
    back = np.zeros((n, k, many), np.int8)
    for t in range(1, n):
        top = best[0] + move[0][:, None]
        for before in range(1, k):
            to = np.flatnonzero(_ALLOWED[before]) if before > 1 else np.arange(k)
            way = best[before] + move[before, to][:, None]
            better = way > top[to]
            back[t, to] = np.where(better, np.int8(before), back[t, to])
            top[to] = np.where(better, way, top[to])
        best = np.where(sizes > t, top + e[t], best)
    label = (best + move[:, :1]).argmax(0)
    path = np.zeros((many, n), np.int64)
    for t in range(n - 1, -1, -1):
        inside = sizes > t
        path[:, t] = np.where(inside, label, 0)
        label = np.where(inside & (t > 0), back[t, label, np.arange(many)], label)
    return path


class Told:
    """What distinct words tell, kept for the words of a task; emptied when full.

    ``own`` is what a word tells at itself and ``near`` at the other ``OFFSETS``, one row for all words (``which``) that tell the same there.
    """

    def __init__(self, emit: np.ndarray):
        self.emit, self.at, self.near_at = emit, {}, {}
        self.own, self.which = np.zeros((1024, emit.shape[1]), np.float32), np.zeros(1024, np.int32)
        self.near = np.zeros((256, len(OFFSETS) - 1, emit.shape[1]), np.float32)

    def _near(self, found: list[list[int]]) -> int:
        key = tuple(map(tuple, found))
        row = self.near_at.get(key)
        if row is None:
            row = self.near_at[key] = len(self.near_at)
            if row == len(self.near):
                self.near = np.append(self.near, np.empty_like(self.near), 0)
            self.near[row] = [self.emit[f].sum(0) for f in found]
        return row

    def of(self, h: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Row of each word in ``own`` and ``which``; ``h`` are the words' keys."""
        distinct, first, index = np.unique(h, return_index=True, return_inverse=True)
        if len(self.at) + len(distinct) > KNOWN:
            self.at.clear()
            self.near_at.clear()
        rows = np.empty(len(distinct), np.int64)
        for j, (x, i) in enumerate(zip(distinct.tolist(), first.tolist())):
            row = self.at.get(x)
            if row is None:
                row = self.at[x] = len(self.at)
                if row == len(self.own):
                    self.own, self.which = np.append(self.own, np.empty_like(self.own), 0), np.append(self.which, np.empty_like(self.which))
                own, *near = features(data[start[i] : end[i]].tobytes().decode())
                self.own[row], self.which[row] = self.emit[own].sum(0), self._near(near)
            rows[j] = row
        return rows[index]


def labels_of(h: np.ndarray, doc: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray, told: Told, move: np.ndarray) -> np.ndarray:
    """The label of each word; words come document by document."""
    out = np.zeros(len(h), np.int64)
    if not len(h):
        return out
    new = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    last = np.append(new[1:], len(doc))
    # a labelled stretch of j words has j + 1 moves of its own, so one whose words all gain less than twice the best move's lead over O to O is not worth it
    lead = 2 * max(float(np.where(_ALLOWED, move, -np.inf).max() - move[0, 0]), 0.0)
    core = np.concatenate([np.arange(a, b, CORE) for a, b in zip(new, last)])
    which = np.searchsorted(new, core, "right") - 1
    lo, stop = np.maximum(core - EDGE, new[which]), np.minimum(core + CORE, last[which])
    hi = np.minimum(stop + EDGE, last[which])
    for k in range(0, len(core), CHAINS):  # cores in order, so that a part's words stand together
        a, b = int(lo[k]), int(hi[k : k + CHAINS].max())
        rows = told.of(h[a:b], data, start[a:b], end[a:b])
        gain, near = told.own[rows], told.which[rows]
        for o, shift in enumerate(OFFSETS[1:], 1):
            i, j = (slice(-shift, None), slice(None, shift)) if shift < 0 else (slice(None, -shift), slice(shift, None))
            gain[i] += np.where((doc[a:b][i] == doc[a:b][j])[:, None], told.near[near[j], o - 1], 0)
        worth = np.append(0, np.cumsum(gain[:, 1:].max(1) - gain[:, 0] + lead >= 0))
        part = np.arange(k, min(k + CHAINS, len(core)))
        part = part[worth[hi[part] - a] > worth[lo[part] - a]]
        part = part[np.argsort(hi[part] - lo[part], kind="stable")]
        for q in range(0, len(part), CHAINS):
            some = part[q : q + CHAINS]
            sizes = hi[some] - lo[some]
            at = lo[some][:, None] + np.arange(int(sizes.max()))
            path = viterbi(gain[np.minimum(at, hi[some][:, None] - 1) - a], move, sizes)
            i, t = np.nonzero((at >= core[some][:, None]) & (at < stop[some][:, None]))
            out[at[i, t]] = path[i, t]
    return out


def _trimmed(word: str) -> tuple[int, int]:
    """A word without marks around it."""
    inner = re.search(r"[+(]?[^\W_](?:.*[^\W_])?\)?", word, re.S)
    return inner.span() if inner else (0, len(word))


def _spans(text: str, words: list[tuple[int, int]], labels: np.ndarray, base: list) -> list[tuple[int, int, int]]:
    """Spans of the labelled words that overlap none of ``base``; what is longer than ``MOST_WORDS`` words is a repeated word, no personal data."""
    out, i = [], 0
    marked = np.flatnonzero(labels).tolist()
    while i < len(marked):
        w = marked[i]
        kind, j = int(labels[w] - 1) // 2, i
        while j + 1 < len(marked) and marked[j + 1] == marked[j] + 1 and labels[marked[j + 1]] == 2 + 2 * kind:
            j += 1
        a, b = words[w], words[marked[j]]
        start, end = a[0] + _trimmed(text[a[0] : a[1]])[0], b[0] + _trimmed(text[b[0] : b[1]])[1]
        if start < end and marked[j] - w < MOST_WORDS and not any(s < end and start < e for _, s, e in base):
            out.append((kind, start, end))
        i = j + 1
    return sorted(out)


def find(column: pa.Array, model, told: Told | None = None):
    """(row, text, the patterns' spans, those that the CRF adds) of each text with any; spans are (kind, start, end)."""
    emit, move = model
    told = told or Told(emit)
    data, offsets = W.buffers(column)
    for lo, hi in W.slices(offsets, SLICE):
        part, local = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        start, end, doc = W.bounds(part, local)
        labels = labels_of(alike(W.hashes(part, start, end, False), part, start, end), doc, part, start, end, told, move)
        begin = np.searchsorted(doc, np.arange(hi - lo + 1))
        marks = np.append(0, np.cumsum(labels > 0))
        hits = np.append(0, np.cumsum(_DIGIT[part]))[local]  # a pattern holds a digit or @
        for i in np.flatnonzero((np.diff(hits) > 0) | (marks[begin[1:]] > marks[begin[:-1]])).tolist():
            text = part[local[i] : local[i + 1]].tobytes().decode()
            base = patterns(text) if hits[i + 1] > hits[i] else []
            added = []
            if marks[begin[i + 1]] > marks[begin[i]]:
                added = _spans(text, [m.span() for m in _WORD.finditer(text)], labels[begin[i] : begin[i + 1]], base)
            if base or added:
                yield lo + i, text, base, added


def _listed(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def redacted(text: str, spans) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first covers all."""
    out, at, reach = [], 0, -1
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= reach:
            out += [text[at:start], f"[{KINDS[kind]}]"]
        at = reach = max(reach, end)
    return "".join(out) + text[at:]


def personal_data(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` of every document, n_email, n_ip, n_card, n_phone, n_added (spans of the CRF), base_sha256, spans, and its text with all spans redacted (null stays null)."""
    model = docs.sparkSession.sparkContext.broadcast(train())

    def search(batches):
        told = Told(model.value[0])
        for batch in batches:
            column = batch.column("text")
            n = len(column)
            counts = np.zeros((5, n), np.int64)
            nothing = hashlib.sha256(b"").hexdigest()
            sha, spans, replaced = [nothing] * n, [""] * n, {}
            for i, text, base, added in find(column, model.value, told):
                for kind, _, _ in base:
                    counts[kind, i] += 1
                counts[4, i] = len(added)
                sha[i] = hashlib.sha256(_listed(base).encode()).hexdigest()
                every = sorted([*base, *added])
                spans[i] = _listed(every)
                replaced[i] = redacted(text, every)
            texts = column
            if replaced:
                mask = np.zeros(n, bool)
                mask[list(replaced)] = True
                texts = pa.compute.replace_with_mask(column, pa.array(mask), pa.array([replaced[i] for i in sorted(replaced)], column.type))
            columns = [*[batch.column(c) for c in keep], *[pa.array(x) for x in counts], pa.array(sha), pa.array(spans), texts]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *_COUNTS, "base_sha256", "spans", "redacted"])

    source = short_batches(docs).select(*dict.fromkeys([*keep, "text"]))
    schema = source.select(*keep).schema
    for c in _COUNTS:
        schema = schema.add(c, "long")
    return source.mapInArrow(search, schema.add("base_sha256", "string").add("spans", "string").add("redacted", "string"))


def op8_pii(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, n_added, base_sha256 and spans of every document; null texts have none."""
    return personal_data(docs).drop("redacted")


def redact(docs: DataFrame) -> DataFrame:
    """The documents with personal data in their texts replaced, and n_chars counted anew."""
    rest = [c for c in docs.columns if c not in ("text", "n_chars")]
    named = docs.select(*[F.col(c).alias(f"d_{c}") for c in rest], "text")
    new = {c: F.col(f"d_{c}") for c in rest} | {"text": F.col("redacted")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("redacted").cast(docs.schema["n_chars"].dataType)
    return personal_data(named, tuple(f"d_{c}" for c in rest)).select(*[new[c].alias(c) for c in docs.columns])
