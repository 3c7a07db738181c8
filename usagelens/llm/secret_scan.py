"""Secret scan: candidates by rule, false positives removed by a random forest.

*Candidates* are the values of assignments to a name that speaks of a secret (a quoted one
up to its closing quote on the line, another up to the next blank, quote, comma, semicolon
or closing bracket, whatever the length), private-key blocks (a header, the base64 lines right
after it, and the footer where it follows them; a header without such a line is none, so
text that only mentions one is left alone), values with a provider's prefix (anywhere in the text), and in any
other white-space delimited piece of at least MIN_PIECE characters every run of key
characters that holds a digit. Where one overlaps another of an earlier rule, what is
left of it on either side is a candidate by itself.

*Features* of a candidate: its length; shares of digits, upper case, hexadecimal digits
and distinct characters; entropy; transitions between character classes per character
and the share of neighbouring letters that frequent words have next to each other too;
dictionary coverage (the share of its letters in words of the dictionary, which are the
term classes that at least DICTIONARY_SHARE of all documents hold); path marks (slashes,
dots, at signs, a scheme); and the words around it (names of secrets, names of harmless
digests and numbers, an assignment sign, quotes). Path marks are those of the whole
white-space delimited piece around it, whatever its length; the words are those of the
WINDOW characters before it.

*Labelled findings* train the forest: a candidate counts as a secret if a provider's
prefix or a quoted assignment names it so and the value is not a placeholder, and as a
false positive if it is an address, a link, a path, a plain number, a version, a
placeholder or the value of a digest's or number's name; the rest have no label. Only values
of less than LONG_VALUE characters can be placeholders: a longer one holds such a word by chance. Labels
look at the piece's exact form, the forest at the features, so it also judges what no
rule names. At most SAMPLE_PER_CLASS findings of each rule and class, those with the least
hash, train it; labelled findings from elsewhere can be passed instead (``fit_forest``).
The forest: TREES trees on bootstrap samples, sqrt(features) tried a split, Gini impurity.
Private-key blocks and provider values that are labelled secrets are certain: they stay
secrets (score 1) whatever the forest says.

Counts for the dictionary cover all documents. All candidates of all whole texts are
scored. Places are code points, ``start`` from 0.

Cases: a null or empty text has no candidate; a value that occurs twice is two findings;
with labelled findings of one class or none there is nothing to learn and the rules
alone decide (a label of 1, or an assignment); an empty table gives an empty result;
``redact`` keeps all columns and rows of its input whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import ship, stage, text_or_empty
from usagelens.llm.neardup import HASHES
from usagelens.llm.termclasses import class_frequencies, slots

MIN_PIECE = 16
MIN_RUN = 12
SAMPLE_PER_CLASS = 2000
DICTIONARY_SHARE = 0.01
TREES = 25
DEPTH = 8
MIN_LEAF = 3
THRESHOLD = 0.5
MARK = "[SECRET]"
LONG_VALUE = 64
WINDOW = 200

# Names that announce a secret, and names of harmless look-alikes.
SECRET_NAMES = ("token", "secret", "passw", "pwd", "apikey", "api_key", "api-key", "access_key", "accesskey",
                "private_key", "credential", "auth_key", "client_key")
HARMLESS_NAMES = ("sha1", "sha256", "sha", "md5", "checksum", "digest", "commit", "etag", "uuid", "guid", "isbn",
                  "revision", "version", "page", "doi", "phone", "card")
PLACEHOLDERS = ("example", "placeholder", "changeme", "your_", "your-", "xxxx", "****", "<", "${", "dummy", "todo")

_ASSIGNED = re.compile(
    r"(?i)\b([\w.-]{0,40}(?:" + "|".join(map(re.escape, SECRET_NAMES)) + r")[\w.-]{0,20})[\"']?\s{0,3}(?:=>|:=|=|:)\s{0,3}"
    r"(?:\"((?:[^\"\\\r\n]|\\[^\r\n]){6,})\"|'((?:[^'\\\r\n]|\\[^\r\n]){6,})'|[\"']([^\s\"']{6,})|([^\s\"',;)\]}]{6,}))")
_PROVIDER = re.compile(r"\b(?:AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36,}|xox[abpr]-[0-9A-Za-z-]{10,}|AIza[0-9A-Za-z_-]{35}"
                       r"|sk_live_[0-9A-Za-z]{16,}|eyJ[\w-]{10,}\.[\w-]{10,}\.[\w-]{5,})")
_KEY_HEADER = re.compile(r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----")
_KEY_FOOTER = re.compile(r"-----END [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----")
_KEY_GAP = re.compile(r"(?:\s|\\[nrt])*(?:(?:Proc-Type|DEK-Info|Comment|Version):[^\r\n\\]{0,200}(?:\s|\\[nrt])*){0,4}")
_KEY_BREAK = re.compile(r"[\r\n]|\\[nr]")
_KEY_LINE = re.compile(r"[A-Za-z0-9+/=]+")
_BLANK = re.compile(r"\s")
_PIECE = re.compile(r"\S{%d,}" % MIN_PIECE)
_CORE = re.compile(r"[A-Za-z0-9+/=_\-]{%d,}" % MIN_RUN)
_HARMLESS_FORM = re.compile(
    r"[\w.+-]+@[\w-]+\.[\w.-]+|[a-z]+://\S+|(?:[\w.-]+/){2,}[\w.-]*|[\d.,:/ -]+|v?\d+(?:\.\d+)+\S*", re.I)
_WORD = re.compile(r"[^\W\d_]{3,}")

RULES = ("private_key", "provider", "assigned", "piece")
CERTAIN = ("private_key", "provider")
NAMES = ("length", "digits", "upper", "hex", "distinct", "entropy", "transitions", "pairs", "dictionary", "slashes",
         "dots", "at", "scheme", "secret_name", "harmless_name", "assigned", "quoted")


def key_blocks(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of private-key blocks: to the footer, or to the last base64 line where none
    follows. Short runs of letters are part of a key only as lines of their own before a footer."""
    at = 0
    while header := _KEY_HEADER.search(text, at):
        first = at = header.end()
        last = None
        while True:
            here = _KEY_GAP.match(text, at).end()
            footer, line = _KEY_FOOTER.match(text, here), _KEY_LINE.match(text, here)
            if footer or not line:
                break
            word, own_line = line[0], _KEY_BREAK.search(text, at, here)
            long = len(word) >= MIN_PIECE and not (word.isalpha() and (word.isupper() or word[1:].islower()))
            if not long and not own_line:
                if last is not None:  # the short end of a key on one line
                    footer = _KEY_FOOTER.match(text, _KEY_GAP.match(text, line.end()).end())
                break
            at = line.end()
            last = at if long else last
        if footer and at > first:
            at = footer.end()
            yield header.start(), at
        elif last is not None:
            at = last
            yield header.start(), last


def candidates(text: str) -> list[tuple[int, int, str]]:
    """(start, end, rule), in order, without overlaps: earlier rules take precedence."""
    found: list[tuple[int, int, str]] = []
    low = text.lower()
    if "private key" in low:
        found += [(a, b, "private_key") for a, b in key_blocks(text)]
    found = _add([], found)
    found = _add(found, [(m.start(), m.end(), "provider") for m in _PROVIDER.finditer(text)])
    if any(name in low for name in SECRET_NAMES):
        values = []
        for m in _ASSIGNED.finditer(text):
            values.append((*m.span(m.lastindex), "assigned"))
        found = _add(found, [f for f in _left(found, values) if f[1] - f[0] >= 6])
    runs = [(p.start(), p.end(), "piece") for m in _PIECE.finditer(text) for p in _CORE.finditer(text, m.start(), m.end())]
    return _add(found, [f for f in _left(found, runs) if f[1] - f[0] >= MIN_RUN and any(c.isdigit() for c in text[f[0]:f[1]])])


def _left(taken: list[tuple[int, int, str]], new: list[tuple[int, int, str]]) -> Iterator[tuple[int, int, str]]:
    """What of the new ones lies outside the taken; both in order and without overlaps."""
    k = 0
    for a, b, rule in new:
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        j = k
        while j < len(taken) and taken[j][0] < b:
            if a < taken[j][0]:
                yield a, taken[j][0], rule
            a = taken[j][1]
            j += 1
        if a < b:
            yield a, b, rule


def _add(taken: list[tuple[int, int, str]], new: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Both, in order, without the new ones that overlap a taken one."""
    whole = set(new)
    return sorted(taken + [f for f in _left(taken, new) if f in whole])


class Pieces:
    """The white-space delimited pieces of a text: their ends and marks, each looked up once."""

    def __init__(self, text: str):
        self.text = text
        self.blanks = [m.start() for m in _BLANK.finditer(text)]
        self.seen: dict[tuple[int, int], tuple[list[float], bool]] = {}

    def marks(self, start: int, end: int) -> tuple[list[float], bool]:
        """(share of slashes, of dots, has an at sign, has a scheme; form of a harmless value) of
        the piece, or pieces, that hold the value."""
        i, j = bisect_left(self.blanks, start), bisect_left(self.blanks, end)
        left = self.blanks[i - 1] + 1 if i else 0
        right = self.blanks[j] if j < len(self.blanks) else len(self.text)
        if (left, right) not in self.seen:
            piece = self.text[left:right]
            marks = [piece.count("/") / len(piece), piece.count(".") / len(piece), float("@" in piece), float("://" in piece)]
            self.seen[left, right] = marks, bool(_HARMLESS_FORM.fullmatch(piece.strip("\"'.,;:()[]{}<>*!#$%&|")))
        return self.seen[left, right]

    def before(self, start: int) -> str:
        """What stands before a value: from a little before its piece, of a long piece the last part."""
        i = bisect_left(self.blanks, start)
        left = max(self.blanks[i - 1] + 1 if i else 0, start - WINDOW)
        return self.text[max(0, left - 60):start].lower()


def _names(before: str, names: tuple[str, ...]) -> bool:
    last = before.split()[-4:]
    return any(n in w for w in last for n in names)


def features(pieces: Pieces, start: int, end: int, dictionary: np.ndarray) -> list[float]:
    value, after = pieces.text[start:end], pieces.text[end:end + 1]
    before, (marks, _) = pieces.before(start), pieces.marks(start, end)
    n = len(value)
    kinds = [0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3 for c in value]
    shares = [k / n for k in Counter(value).values()]
    words = _WORD.findall(value.lower())
    known = [w for w in words if _in(w, dictionary)]
    pairs = sum(a.isalpha() and b.isalpha() and (a + b) in FREQUENT_PAIRS for a, b in zip(value.lower(), value.lower()[1:]))
    return [float(n), kinds.count(0) / n, kinds.count(2) / n, sum(c in "0123456789abcdefABCDEF" for c in value) / n,
            len(shares) / n, -sum(s * math.log2(s) for s in shares),
            sum(a != b for a, b in zip(kinds, kinds[1:])) / n, pairs / n, sum(map(len, known)) / n,
            *marks, float(_names(before, SECRET_NAMES)), float(_names(before, HARMLESS_NAMES)),
            float(before.rstrip("\"' ")[-1:] in ("=", ":")), float(before[-1:] in ("\"", "'") and after in ("\"", "'"))]


# Frequent neighbouring letters of the languages in the tables.
FREQUENT_PAIRS = frozenset("th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve "
                           "co me de hi ri ro ic ne ea ra ce li ch ll be ma si om ur ei ie un el us ue qu em la os do ad".split())


def _in(word: str, dictionary: np.ndarray) -> bool:
    h = np.frombuffer(HASHES[word.encode()], "<u8")
    return bool(dictionary[slots(h)][0])


def label(pieces: Pieces, start: int, end: int, rule: str) -> int | None:
    """1 a secret, 0 a false positive, None unknown."""
    value = pieces.text[start:end]
    if rule == "private_key":
        return 1
    before, low = pieces.before(start), value.lower()
    if len(value) < LONG_VALUE and any(p in low for p in PLACEHOLDERS) or len(set(value)) <= 3:
        return 0
    if rule in CERTAIN:
        return 1
    if rule == "assigned":
        return 1 if before[-1:] in ("\"", "'") and len(value) >= 12 and any(c.isdigit() for c in value) else None
    if pieces.marks(start, end)[1] or _names(before, HARMLESS_NAMES):
        return 0
    return None


class Forest:
    """Trees as arrays: feature, limit, left, right, value; a leaf has feature -1."""

    def __init__(self, trees: list[tuple[np.ndarray, ...]]):
        self.trees = trees

    def probability(self, rows: np.ndarray) -> np.ndarray:
        total = np.zeros(len(rows))
        for feature, limit, left, right, value in self.trees:
            at = np.zeros(len(rows), np.int64)
            for _ in range(DEPTH + 1):
                f = feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                go = rows[np.arange(len(rows)), np.maximum(f, 0)] <= limit[at]
                at = np.where(inner, np.where(go, left[at], right[at]), at)
            total += value[at]
        return total / max(1, len(self.trees))


def fit_forest(x: np.ndarray, y: np.ndarray, trees: int = TREES, seed: int = 20260101) -> Forest:
    rng = np.random.default_rng(seed)
    tried = max(1, int(math.sqrt(x.shape[1])))
    grown = []
    for _ in range(trees):
        pick = rng.integers(0, len(x), len(x))
        nodes: list[list[float]] = []

        def grow(rows: np.ndarray, depth: int) -> int:
            me = len(nodes)
            share = float(y[rows].mean())
            nodes.append([-1, 0.0, 0, 0, share])
            if depth == DEPTH or len(rows) < 2 * MIN_LEAF or share in (0.0, 1.0):
                return me
            best = None
            for f in rng.permutation(x.shape[1])[:tried]:
                order = rows[np.argsort(x[rows, f], kind="stable")]
                v, ones = x[order, f], np.cumsum(y[order])
                n = np.arange(1, len(order))
                a, b = ones[:-1], ones[-1] - ones[:-1]
                m = len(order) - n
                gini = 2 * (a * (n - a) / n + b * (m - b) / m)
                ok = (v[1:] > v[:-1]) & (n >= MIN_LEAF) & (m >= MIN_LEAF)
                if ok.any():
                    k = int(np.argmin(np.where(ok, gini, np.inf)))
                    if best is None or gini[k] < best[0]:
                        best = (gini[k], f, (v[k] + v[k + 1]) / 2)
            if best is None:
                return me
            go = x[rows, best[1]] <= best[2]
            nodes[me][:2] = [best[1], best[2]]
            nodes[me][2] = grow(rows[go], depth + 1)
            nodes[me][3] = grow(rows[~go], depth + 1)
            return me

        grow(pick, 0)
        cols = list(zip(*nodes))
        grown.append(tuple(np.array(c, t) for c, t in zip(cols, (np.int64, float, np.int64, np.int64, float))))
    return Forest(grown)


class Scanner:
    """Dictionary and forest (None: the rules alone decide)."""

    def __init__(self, dictionary: np.ndarray, forest: Forest | None):
        self.dictionary, self.forest = dictionary, forest

    def scan(self, text: str) -> list[tuple[int, int, str, float]]:
        """(start, end, rule, probability) of every candidate."""
        found = candidates(text)
        if not found:
            return []
        pieces = Pieces(text)
        if self.forest is None:
            marks = [label(pieces, *f) for f in found]
            p = [float(m) if m is not None else float(f[2] == "assigned") for m, f in zip(marks, found)]
        else:
            p = self.forest.probability(np.array([features(pieces, a, b, self.dictionary) for a, b, _ in found])).tolist()
            p = [1.0 if f[2] in CERTAIN and label(pieces, *f) == 1 else q for f, q in zip(found, p)]
        return [(*f, q) for f, q in zip(found, p)]


def labelled_batches(batches: Iterator[pa.RecordBatch], dictionary: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for t in batch.column(0):
            text = t.as_py()
            found = candidates(text)
            pieces = Pieces(text) if found else None
            for a, b, rule in found:
                y = label(pieces, a, b, rule)
                if y is not None:
                    value = hashlib.sha256(text[max(0, a - 40):b].encode()).hexdigest()
                    rows.append({"mark": value, "rule": rule, "y": y, "x": features(pieces, a, b, dictionary)})
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(
            [("mark", pa.string()), ("rule", pa.string()), ("y", pa.int32()), ("x", pa.list_(pa.float64()))]))


def train(docs: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Scanner:
    spark = docs.sparkSession
    ship(spark)
    df, n = class_frequencies(docs)
    dictionary = df >= max(2.0, DICTIONARY_SHARE * n)
    shared = spark.sparkContext.broadcast(dictionary)  # one mark per term class
    found = stage(docs.select(text_or_empty().alias("t")).mapInArrow(lambda it: labelled_batches(it, shared.value),
                                                                     "mark string, rule string, y int, x array<double>")
                  .groupBy("mark", "rule", "y").agg(F.min("x").alias("x")), "labelled-findings")
    least = lambda rule, y: found.where((F.col("rule") == rule) & (F.col("y") == y)).orderBy("mark").limit(per_class)
    rows = [r for rule in RULES for y in (0, 1) for r in least(rule, y).collect()]  # at most 8 * per_class rows
    y = np.array([r["y"] for r in rows], np.int64)
    if not 0 < y.sum() < len(y):
        return Scanner(dictionary, None)
    return Scanner(dictionary, fit_forest(np.array([r["x"] for r in rows], float), y))


FINDINGS = "doc_id long, start long, length long, rule string, value_sha256 string, score double, is_secret boolean"


def findings(docs: DataFrame, scanner: Scanner) -> DataFrame:
    """A row per candidate: doc_id, start, length, rule, value_sha256 (never the value),
    score, is_secret."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(scanner)  # bounded: one mark per term class and TREES small trees

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in range(7)]
            for doc_id, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = t.as_py()
                for a, b, rule, p in shared.value.scan(text):
                    for c, v in zip(cols, (doc_id, a, b - a, rule, hashlib.sha256(text[a:b].encode()).hexdigest(), p,
                                           p >= THRESHOLD)):
                        c.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=[f.split()[0] for f in FINDINGS.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("t")).mapInArrow(scan, FINDINGS)


def redact(docs: DataFrame, scanner: Scanner) -> DataFrame:
    """All rows and columns; secrets in ``text`` replaced by MARK, ``n_chars`` (if there)
    set to the new length where a text changed."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(scanner)

    def clean(text: str | None) -> str | None:
        if text is None:
            return None
        parts, at = [], 0
        for a, b, _, p in shared.value.scan(text):
            if p >= THRESHOLD:
                parts += [text[at:a], MARK]
                at = b
        return "".join(parts) + text[at:] if parts else text

    def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            i, j = batch.schema.get_field_index("text"), batch.schema.get_field_index("n_chars")
            before = batch.column(i).to_pylist()
            after = [clean(t) for t in before]
            columns = list(batch.columns)
            columns[i] = pa.array(after, batch.schema.field(i).type)
            if j >= 0:
                sizes = [len(b) if a is not b else n for a, b, n in zip(before, after, batch.column(j).to_pylist())]
                columns[j] = pa.array(sizes, batch.schema.field(j).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(batches_of, docs.schema)
