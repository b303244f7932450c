"""Secret scans: find candidate strings, then let a random forest judge them.

A candidate is a run of at least 16 of ``[A-Za-z0-9+/_-]`` with a digit in it
(with its closing ``=``), a dotted token, a private-key block from BEGIN to
END, what is assigned to a secret word (quoted or bare, 6 characters or more of
any kind), or the password of a URL.  Candidates may lie in one another; each
is judged, and what is masked is their union.  The forest sees its length, its
transitions between character kinds, how much of it dictionary words cover, how
path-like it and its surroundings are, and the words before it; it removes
hashes, identifiers, paths and placeholders.

No table holds labelled findings, so the forest learns from ``FINDINGS``
labelled findings that a seeded generator draws (keys of common formats and
assigned passwords against digests, UUIDs, paths, slugs, versions and
placeholders, each in its usual surroundings).  It is trained in numpy on the
driver and is the same for every input.

Null and empty texts have no candidates; a text of any length is scanned
whole; repeated rows are scanned each.  An empty table gives no rows.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import clean_columns, slices

FINDINGS = 4000
TREES, DEPTH, LEAF = 40, 9, 4
THRESHOLD = 0.5
MASK = "[SECRET]"
CONTEXT = 40

# Each pattern begins only where a run does and never gives characters back, so
# that a text of any kind is scanned in time that grows with its length.
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_-])(?P<bare>[A-Za-z0-9+/_-]{16,}+={0,2})")
WEB_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])(?>[A-Za-z0-9_-]*?(?=eyJ))(?P<bare>eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+)")
SERVICE = re.compile(r"\b(?P<bare>SG\.[A-Za-z0-9_-]{6,}+\.[A-Za-z0-9_-]{6,}+)")
KEY_BLOCK = re.compile(r"(?P<bare>-----BEGIN [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----.*?-----END [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----)", re.DOTALL)
KEY_END = re.compile(r"-----END [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----")
ASSIGNED = re.compile(
    r"(?:passw(?:or)?d|passphrase|(?<![a-z])pass|pwd|secret|token|credentials?|(?:api|access|auth|account|private|encryption|signing|master)[_-]?key)"
    r"[A-Za-z0-9_-]{0,30}(?:[\"'\]]{0,2}\s{0,4}(?:=>|:=|==?|:)\s{0,4})"
    r"(?:\"(?P<double>(?:[^\"\\\n]|\\.){6,})\"|'(?P<single>(?:[^'\\\n]|\\.){6,})'|(?P<bare>[^\s\"'<>]{5,}[^\s\"'<>,;.]))",
    re.IGNORECASE,
)
BEARER = re.compile(r"\bbearer\s{1,4}(?P<bare>[A-Za-z0-9._~+/-]{16,}={0,2})", re.IGNORECASE)
URL_LOGIN = re.compile(r"(?<![A-Za-z0-9+.-])[A-Za-z][A-Za-z0-9+.-]*+://[^\s/:@]*:(?P<bare>[^\s/]+)@")
# Words that stand before secrets, and before look-alikes.
SECRET_WORDS = ("password", "passwd", "pwd", "secret", "token", "apikey", "api_key", "api-key", "access_key", "auth", "bearer", "credential", "private", "aws", "key")
OTHER_WORDS = ("commit", "sha", "sha1", "sha256", "md5", "checksum", "digest", "hash", "uuid", "guid", "id", "version", "build", "path", "file", "url", "http", "https", "href", "src", "image", "example", "sample", "isbn", "order", "ticket")
DICTIONARY = (
    "the and for with from this that file test main data user name path home index image build config server client public static "
    "source target module package version release update install system network document report example sample your here change "
    "java python script style asset upload download archive backup project service account order item page post article news blog "
    "title summary section chapter table value number string object class method function string list map set get put key"
).split()
WORDS = re.compile("|".join(sorted({w for w in DICTIONARY if len(w) > 2}, key=len, reverse=True)))
HEX = re.compile("[0-9a-f]+|[0-9A-F]+")
UUID = re.compile("[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}")
BEFORE_WORD = re.compile(r"[A-Za-z_-]+\d*")

SCHEMA = "doc_id long, start long, stop long, kind string, score double, is_secret boolean"
KINDS = (("private_key", re.compile("-----BEGIN ")), ("web_token", re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]*+\.")), ("service_token", re.compile(r"SG\.[A-Za-z0-9_-]+\.")), ("access_key", re.compile("(AKIA|ASIA)[0-9A-Z]{16}$")), ("service_token", re.compile("(gh[pousr]_|xox[abpr]-|sk[-_]|AIza|glpat-)")))


# Kinds of the ASCII characters: digit, lower, upper, other.
ASCII_KINDS = np.array([0 if chr(c).isdigit() else 1 if chr(c).islower() else 2 if chr(c).isupper() else 3 for c in range(128)], np.int8)


def char_kind(text: str) -> np.ndarray:
    if text.isascii():
        return ASCII_KINDS[np.frombuffer(text.encode(), np.uint8)]
    return np.array([0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3 for c in text], np.int8)


def features(value: str, before: str, after: str) -> list[float]:
    kinds = char_kind(value)
    n = len(kinds)
    counts = np.bincount(kinds, minlength=4) / n
    raw = np.frombuffer(value.encode(errors="replace"), np.uint8)
    letters = np.unique(raw, return_counts=True)[1] / len(raw)
    lower = value.lower()
    covered = sum(m.end() - m.start() for m in WORDS.finditer(lower)) / len(value)
    near = [w.lower().strip("-_") for w in BEFORE_WORD.findall(before)[-3:]]
    tail = before.rstrip("\"' ")
    steps = int((kinds[1:] != kinds[:-1]).sum())
    return [
        len(value),
        steps / n,
        int(((kinds[1:] == 0) != (kinds[:-1] == 0)).sum()) / n,
        *counts,
        float(-(letters * np.log2(letters)).sum()),
        covered,
        float(bool(HEX.fullmatch(value))),
        float(bool(UUID.fullmatch(value))),
        value.count("/") / n,
        value.count("-") / n,
        float(any(k.search(value) for _, k in KINDS)),
        float(before.endswith(("/", "\\", ".", ":", "#", "@")) or after.startswith(("/", ".", "\\"))),
        float(tail.endswith(("=", ":"))),
        float(any(w in SECRET_WORDS or w.endswith(("password", "secret", "token", "key")) for w in near)),
        float(any(w in OTHER_WORDS for w in near)),
        float(before.endswith(("\"", "'"))),
        sum(map(str.isspace, value)) / n,
        sum(map(value.count, "(){}<>[]$*")) / n,
        float("://" in before and after.startswith("@")),
    ]


def labelled_findings(n: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of ``n`` drawn findings, half of them secrets."""
    rng = np.random.default_rng(seed)
    pick = lambda options: options[int(rng.integers(len(options)))]
    draw = lambda alphabet, k: "".join(alphabet[i] for i in rng.integers(0, len(alphabet), k))
    hexes, alnum, upper = "0123456789abcdef", string.ascii_letters + string.digits, string.ascii_uppercase + string.digits
    word = lambda: pick(DICTIONARY) if rng.random() < 0.6 else draw(string.ascii_lowercase, int(rng.integers(2, 9)))
    prose = lambda: " ".join(draw(string.ascii_lowercase, int(rng.integers(2, 8))) for _ in range(4))
    some = lambda a, b: int(rng.integers(a, b))

    marks = "!#%&*+-.?@^_~"
    mangled = lambda: pick((str.title, str.upper, str.lower))(pick([w for w in DICTIONARY if len(w) > 3])).replace("o", "0").replace("a", pick(("4", "@", "a"))) + draw(string.digits, some(1, 5)) + pick(("", draw(marks, 1), draw(marks, 1) + draw(alnum, 2)))
    short = lambda: pick((lambda: draw(alnum + marks, some(8, 22)), lambda: draw(string.ascii_letters, some(10, 33)), mangled, mangled, lambda: draw(string.ascii_letters, 4) + draw(marks, 1) + draw(alnum, some(4, 10))))()

    def block() -> str:
        kind = pick(("RSA PRIVATE KEY", "EC PRIVATE KEY", "PRIVATE KEY", "ENCRYPTED PRIVATE KEY", "OPENSSH PRIVATE KEY", "PGP PRIVATE KEY BLOCK"))
        head = pick(("", "", "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC," + draw(upper, 32) + "\n\n", "Version: GnuPG v2\n\n"))
        lines = "\n".join(draw(alnum + "+/", 64) for _ in range(some(1, 25)))
        return f"-----BEGIN {kind}-----\n{head}{lines}\n-----END {kind}-----"

    def assigned(value: str) -> tuple[str, str, str]:
        name = pick(("password", "passwd", "pwd", "secret", "token", "api_key", "DB_PASSWORD", "client_secret", "passphrase", "pass"))
        join, close = pick((("=", " "), (": ", " "), (" = \"", "\""), ("=\"", "\""), ("='", "'"), ("\": \"", "\"")))
        return value, f"{prose()} {name}{join}", close + pick(("", " ", ", ")) + prose()

    def at_url(value: str) -> tuple[str, str, str]:
        return value, f"{prose()} {pick(('postgres', 'mysql', 'https', 'redis', 'amqp', 'mongodb+srv'))}://{word()}:", f"@{word()}.{pick(('example.com', 'internal', 'local:5432'))}/{word()}"

    def secret() -> tuple[str, str, str]:
        sort = rng.random()
        if sort < 0.3:
            return (at_url if rng.random() < 0.3 else assigned)(short())
        if sort < 0.36:
            return block(), prose() + pick((" ", "\n", ": ")), "\n" + prose()
        if sort < 0.4:
            value = f"SG.{draw(alnum + '_-', some(6, 24))}.{draw(alnum + '_-', some(6, 44))}"
            return assigned(value) if rng.random() < 0.5 else (value, prose() + " ", " " + prose())
        name = pick(("password", "passwd", "secret", "token", "api_key", "apikey", "auth_token", "access_key", "client_secret", "DB_PASSWORD", "bearer"))
        join = pick(("=", " = ", ": ", ":", " = \"", "=\"", "=\'", " "))
        value = pick(
            (
                lambda: pick(("AKIA", "ASIA")) + draw(upper, 16),
                lambda: pick(("ghp_", "gho_", "ghs_")) + draw(alnum, 36),
                lambda: pick(("sk-", "sk_live_", "xoxb-", "glpat-")) + draw(alnum, some(20, 48)),
                lambda: "AIza" + draw(alnum + "_-", 35),
                lambda: "eyJ" + draw(alnum, some(12, 30)) + "." + draw(alnum, some(20, 60)) + "." + draw(alnum + "_-", 40),
                lambda: "",
                lambda: "",
            )
        )()
        if value:
            return value, prose() + (f" {name}{join}" if rng.random() < 0.4 else " "), " " + prose()
        value = pick((lambda: draw(hexes, pick((16, 18, 20, 24, 32, 40, 64))), lambda: draw(alnum, some(16, 44)), lambda: draw(alnum + "+/", 40)))()
        return value, f"{prose()} {name}{join}", pick(("", "\"", "'", ";", " ")) + prose()

    def other() -> tuple[str, str, str]:
        if rng.random() < 0.3:
            plain = lambda: pick((pick([w for w in DICTIONARY if len(w) > 5]), draw(string.ascii_lowercase, some(6, 12)), draw(string.ascii_lowercase, some(6, 10)).title()))
            value = pick(
                (
                    plain,
                    plain,
                    prose,
                    lambda: word() + "_" + plain(),
                    lambda: f"{word()}.{word()}({pick(('', word()))})" + pick(("", "]")) + "x" * 3,
                    lambda: f"get_{plain()}()",
                    lambda: "${" + pick(("TOKEN", "DB_PASSWORD", "secrets.KEY")) + "}",
                    lambda: pick(("required", "changeme", "optional", "undefined", "password", "example", "your-password", "*" * some(6, 12), "x" * some(6, 16), "[REDACTED]", "[hidden]")),
                    lambda: " ".join((plain(), word(), word())),
                )
            )()
            return (at_url if " " not in value and "(" not in value and rng.random() < 0.1 else assigned)(value)
        return pick(
            (
                lambda: (draw(hexes, pick((32, 40, 64))), f"{prose()} {pick(('commit', 'sha256', 'md5', 'checksum', 'digest', 'hash'))}{pick((' ', ': ', '='))}", " " + prose()),
                lambda: ("-".join(draw(hexes, k) for k in (8, 4, 4, 4, 12)), f"{prose()} {pick(('id', 'uuid', 'request', 'order'))}{pick((' ', '=', ': '))}", " " + prose()),
                lambda: ("/".join(word() for _ in range(some(3, 6))) + str(some(1, 99)), f"{prose()} {pick(('path', 'file', 'see', 'in'))} ", "." + word()),
                lambda: ("-".join(word() for _ in range(some(3, 7))) + "-" + str(some(1, 9999)), f"{prose()} https://{word()}.example.com/", " " + prose()),
                lambda: ("_".join(word() for _ in range(some(3, 5))) + str(some(1, 99)), prose() + " ", " " + prose()),
                lambda: (pick(("your-api-key-here-123", "xxxxxxxxxxxxxxxx1234", "EXAMPLE0KEY0EXAMPLE0", "0000000000000000", "1234567890123456", "change-me-please-123")), f"{prose()} {pick(('password', 'token', 'api_key'))}=", " " + prose()),
                lambda: (draw(string.digits, some(16, 24)), f"{prose()} {pick(('order', 'isbn', 'number', 'phone', 'ticket'))} ", " " + prose()),
                lambda: (draw(string.ascii_lowercase, some(14, 30)) + str(some(1, 9)), prose() + " ", pick((" ", ". ", ", ")) + prose()),
                lambda: (word().title() + word().title() + word().title() + "Test" + str(some(1, 99)), prose() + " class ", " " + prose()),
                lambda: (draw(alnum + "+/", some(60, 400)), f"{prose()} data:image/png;base64,", "\" " + prose()),
            )
        )()

    rows = [(secret, 1) if i % 2 else (other, 0) for i in range(n)]
    return np.array([features(*(lambda f: (f[0], f[1][-CONTEXT:], f[2][:CONTEXT]))(make())) for make, _ in rows]), np.array([y for _, y in rows], float)


class Forest:
    """Bagged trees on random feature subsets; all nodes lie in flat arrays."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.feature, self.cut, self.left, self.right, self.value, self.roots = [], [], [], [], [], []
        for _ in range(TREES):
            i = rng.integers(0, len(y), len(y))
            self.roots.append(self.grow(x[i], y[i], rng, DEPTH))
        for k in ("feature", "cut", "left", "right", "value"):
            setattr(self, k, np.array(getattr(self, k)))

    def grow(self, x: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int) -> int:
        node = len(self.value)
        for part, v in zip((self.feature, self.cut, self.left, self.right, self.value), (-1, 0.0, node, node, y.mean()), strict=True):
            part.append(v)
        best = (y.var() * len(y) - 1e-9, None, None) if depth and len(y) >= 2 * LEAF else (0, None, None)
        for f in rng.choice(x.shape[1], max(2, int(x.shape[1] ** 0.5)), replace=False) if best[0] > 0 else ():
            order = np.argsort(x[:, f], kind="stable")
            v, s = x[order, f], np.cumsum(y[order])
            n = np.arange(1, len(y) + 1)
            # Gini impurity of both sides of each cut, times their sizes.
            a, b = s[:-1], s[-1] - s[:-1]
            loss = a - a * a / n[:-1] + b - b * b / (len(y) - n[:-1])
            loss[(v[1:] == v[:-1]) | (n[:-1] < LEAF) | (len(y) - n[:-1] < LEAF)] = np.inf
            k = int(np.argmin(loss))
            if loss[k] < best[0]:
                best = (loss[k], f, (v[k] + v[k + 1]) / 2)
        if best[1] is not None:
            go = x[:, best[1]] <= best[2]
            self.feature[node], self.cut[node] = int(best[1]), best[2]
            self.left[node] = self.grow(x[go], y[go], rng, depth - 1)
            self.right[node] = self.grow(x[~go], y[~go], rng, depth - 1)
        return node

    def score(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(DEPTH):
                f = self.feature[at]
                go = x[rows, np.maximum(f, 0)] <= self.cut[at]
                at = np.where(f < 0, at, np.where(go, self.left[at], self.right[at]))
            total += self.value[at]
        return total / len(self.roots)


#: What an assignment, and a bearer, must hold, in lower case.
ASSIGNED_TO = ("pass", "pwd", "secret", "token", "credential", "key")


def spans(text: str) -> list[tuple[int, int]]:
    """Places of all candidates, each once."""
    out = {m.span() for m in TOKEN.finditer(text) if any(map(str.isdigit, m[0]))}
    lower = text.lower()
    patterns = [ASSIGNED] * any(w in lower for w in ASSIGNED_TO) + [BEARER] * ("bearer" in lower) + [URL_LOGIN] * ("://" in text) + [WEB_TOKEN] * ("eyJ" in text) + [SERVICE] * ("SG." in text)
    out |= {m.span(m.lastgroup) for p in patterns for m in p.finditer(text)}
    if "PRIVATE KEY" in text:
        # Behind the last end no block can begin.
        ends = [m.end() for m in KEY_END.finditer(text)]
        out |= {m.span() for m in KEY_BLOCK.finditer(text, 0, ends[-1])} if ends else set()
    return sorted(out)


def union(places: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """text, start, stop in order, with what overlaps made one."""
    out: list[tuple[int, int, int]] = []
    for i, a, b in places:
        if out and out[-1][0] == i and a < out[-1][2]:
            out[-1] = (i, out[-1][1], max(b, out[-1][2]))
        else:
            out.append((i, a, b))
    return out


def find(texts: list[str | None]) -> tuple[list[int], list[int], list[int], list[str], np.ndarray]:
    """text, start, stop, value and features of every candidate."""
    row, start, stop, value, rows = [], [], [], [], []
    for i, text in enumerate(texts):
        for a, b in spans(text or ""):
            row.append(i)
            start.append(a)
            stop.append(b)
            value.append(text[a:b])
            rows.append(features(text[a:b], text[max(0, a - CONTEXT) : a], text[b : b + CONTEXT]))
    return row, start, stop, value, np.array(rows, float)


def kind_of(value: str) -> str:
    return next((name for name, k in KINDS if k.match(value)), "generic")


def trained(docs: DataFrame):
    return docs.sparkSession.sparkContext.broadcast(Forest(*labelled_findings(FINDINGS)))


def secret_scan(docs: DataFrame) -> DataFrame:
    """Every candidate with its place in code points, score and verdict."""
    forest = trained(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                row, start, stop, value, x = find(part.column("text").to_pylist())
                if row:
                    score = forest.value.score(x)
                    yield pa.record_batch([part.column("doc_id").take(pa.array(row)), pa.array(start, pa.int64()), pa.array(stop, pa.int64()), pa.array([kind_of(v) for v in value]), pa.array(score), pa.array(score >= THRESHOLD)], names=["doc_id", "start", "stop", "kind", "score", "is_secret"])

    docs = clean_columns(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return docs.mapInArrow(run, SCHEMA)


def masked(docs: DataFrame) -> DataFrame:
    """The documents, all columns, with each secret in ``text`` masked."""
    forest = trained(docs)
    names = docs.columns
    at = names.index("text")
    inner = docs.toDF(*(f"c{i}" if i != at else "text" for i in range(len(names))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                texts = part.column("text").to_pylist()
                row, start, stop, _, x = find(texts)
                secret = forest.value.score(x) >= THRESHOLD if row else ()
                # From the last place back, so earlier places stay right.
                for i, a, b in union([(i, a, b) for i, a, b, s in zip(row, start, stop, secret, strict=True) if s])[::-1]:
                    texts[i] = texts[i][:a] + MASK + texts[i][b:]
                yield part.set_column(part.schema.get_field_index("text"), "text", pa.array(texts, pa.string()))

    out = inner.mapInArrow(run, inner.schema).toDF(*names)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out
