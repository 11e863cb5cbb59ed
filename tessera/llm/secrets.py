"""Secret scans with a random forest that removes false positives.

Candidates are runs of 16 token characters and more, and values of 8 printable characters and more right behind an
assignment (= : >), each with the text around it. SQL expressions turn a candidate into features: length, character
transitions, coverage by dictionary words, path marks and neighbouring words. The dictionary is learned from the documents:
the words that most of them hold. A random forest trained on labelled findings gives the share of trees that call a
candidate a secret. The trees are compiled to CASE expressions, so a scan is one projection over the documents with no
Python and no shuffle of texts; only the numbers of documents with a finding are shuffled, to place their spans.

Defined results: null and empty texts have no findings; texts of any length are scanned whole; repeated rows, and rows that
share an id (null ids too), have findings each; an empty table gives an empty result; other columns of the input, whatever
their names, are kept by redact() and ignored by findings(). A finding starts at a code point counted from 0. Values of
fewer than 8 characters, and of fewer than 16 without an assignment before them, are no candidates.
"""

from __future__ import annotations

import json
import random
import string

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import free_names, read

#: A value behind an assignment, or a whole run of token characters of some length; an = before more of them ends a name.
CANDIDATE = r"(?<=[=:>][ \"'`]{0,2})(?![/=\-])[!-~&&[^\"'`<>()\[\]{},;]]{7,}[A-Za-z0-9+/=_!@#$%^&*?~\-]|(?<![\p{L}0-9+/_\-])[A-Za-z0-9+/_\-]{16,}+(?!\p{L})(?:={1,2}(?![A-Za-z0-9+/_=\-]))?"
#: The least lengths of a candidate, with which bounded neighbours make up its context.
SHORTEST = 8
BEFORE, AFTER = 64, 32
TREES, DEPTH, LEAST = 15, 6, 4
#: Labelled findings drawn for training, at most.
TRAIN_ROWS = 4000
#: Words in the dictionary, and their lengths.
WORDS, WORD_LENGTHS = 200, (4, 12)
CONFIRMED = 0.5

#: Neighbouring words that speak for and against a secret, and words found inside harmless tokens.
SECRET_WORDS = ("token", "secret", "password", "passwd", "pwd", "apikey", "api_key", "api-key", "access_key", "private", "credential", "auth", "bearer", "signing", "client_secret")
PLAIN_WORDS = ("commit", "sha1", "sha256", "md5", "checksum", "digest", "hash", "uuid", "revision", "etag", "isbn", "card", "order", "phone", "version", "build", "session", "serial", "integrity", "fingerprint")
#: Parts of the harmless paths and names of the labelled findings.
PATH_PARTS = ("example", "sample", "file", "path", "index", "image", "page", "article", "user", "data", "value", "version", "release", "build", "config", "service", "server", "client", "report", "content", "static", "assets", "document")

#: Feature name to SQL over the candidate c and the text before (b) and after (a) it.
FEATURES = {
    "length": "length(c)",
    "digits": "length(regexp_replace(c, '[^0-9]', '')) / length(c)",
    "uppers": "length(regexp_replace(c, '[^A-Z]', '')) / length(c)",
    "hexes": "length(regexp_replace(c, '[^0-9a-f]', '')) / length(c)",
    "marks": "length(regexp_replace(c, '[A-Za-z0-9]', '')) / length(c)",
    "turns": "(regexp_count(c, '[0-9][A-Za-z]') + regexp_count(c, '[A-Za-z][0-9]') + regexp_count(c, '[a-z][A-Z]') + regexp_count(c, '[A-Z][a-z]')) / length(c)",
    "rare_pairs": "regexp_count(lower(c), '[bcdfghjklmnpqrstvwxz]{3}') / length(c)",
    "words": "1 - length(regexp_replace(lower(c), '__WORDS__', '')) / length(c)",
    "slashes": "length(regexp_replace(c, '[^/]', ''))",
    "in_path": "CASE WHEN b rlike '(://|[/\\\\\\\\.]|www)[^ ]*$' OR a rlike '^[/.][A-Za-z]' THEN 1 ELSE 0 END",
    "assigned": "CASE WHEN b rlike '[A-Za-z_\\\\-][\"\\']? *(=|:|=>|:=) *[\"\\']?$' THEN 1 ELSE 0 END",
    "quoted": "CASE WHEN b rlike '[\"\\'`]$' AND a rlike '^[\"\\'`]' THEN 1 ELSE 0 END",
    "secret_near": f"CASE WHEN lower(b) rlike '({'|'.join(SECRET_WORDS)})[^ ]*[^A-Za-z]{{0,6}}$' THEN 2 WHEN lower(b) rlike '({'|'.join(SECRET_WORDS)})' THEN 1 ELSE 0 END",
    "plain_near": f"CASE WHEN lower(b) rlike '({'|'.join(PLAIN_WORDS)})[^ ]*[^A-Za-z]{{0,6}}$' THEN 2 WHEN lower(b) rlike '({'|'.join(PLAIN_WORDS)})' OR lower(a) rlike '({'|'.join(PLAIN_WORDS)})' THEN 1 ELSE 0 END",
    "known_form": "CASE WHEN c rlike '^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{30,}|sk[-_](live|test)?[-_]?[A-Za-z0-9]{20,}|xox[bpars]-[0-9A-Za-z-]{10,}|AIza[0-9A-Za-z_-]{30,}|eyJ[A-Za-z0-9_-]{10,})' THEN 1 ELSE 0 END",
}


#: Quotes, or none.
QUOTES = ('"', "'", "")


def labelled_findings(n: int = 2400, seed: int = 3) -> list[tuple[str, str, str, int]]:
    """(before, candidate, after, label) findings of usual kinds, made by rule: real secrets are never stored in code."""
    r = random.Random(seed)
    chars = string.ascii_letters + string.digits

    def of(alphabet: str, low: int, high: int | None = None) -> str:
        return "".join(r.choice(alphabet) for _ in range(r.randint(low, high or low)))

    def prose(k: int = 5) -> str:
        return " ".join(of("etaoinshrdlu", 2, 9) for _ in range(k))

    def fragments(low: int, high: int) -> str:
        return "".join(r.choice(("tion", "er", "ent", "house", "ing", "the", "re", "at", "on", "schaft", "ment", "eau", "ch", "stsch", "pf", "tz", "ung", "wh", "an")) for _ in range(r.randint(low, high))).encode("ascii", "ignore").decode()

    def secret() -> tuple[str, str, str]:
        name = r.choice(("token", "secret", "api_key", "password", "access_key", "client_secret", "auth_token", "private_key", "SECRET_KEY", "credential"))
        value = r.choice((lambda: of("0123456789abcdef", r.choice((16, 18, 20, 24, 32, 40, 40, 40, 48, 64))), lambda: of(chars, 16, 64), lambda: of(chars + "+/", 24, 64) + "=" * r.randint(0, 2), lambda: of(chars + "-_", 20, 48)))()
        form = r.random()
        if form < 0.25:
            return f"{prose()} ", r.choice((lambda: "AKIA" + of(string.ascii_uppercase + r.choice(("", string.digits)), 16), lambda: "ghp_" + of(chars, 36), lambda: "sk_live_" + of(chars, 24), lambda: "xoxb-" + of(chars, 40), lambda: "eyJ" + of(chars, 40, 90)))(), f" {prose(2)}"
        if form < 0.4:
            return f"{prose()} Authorization: Bearer ", value, f"\n{prose(2)}"
        quote = r.choice('"\'"" ').strip()
        if form < 0.5:
            return f"{prose()} {r.choice(('the', 'my', 'our new'))} {r.choice(('secret', 'password', 'token', 'api key'))} {r.choice(('is', 'was'))} {r.choice(QUOTES)}", r.choice((value, of(string.ascii_lowercase, 18, 32))), f"{r.choice(QUOTES)} {prose(2)}"
        if form < 0.65:
            value = r.choice((lambda: of(chars + "!@#$%&*?", 8, 15), lambda: of(string.ascii_lowercase, 4, 8) + of(string.digits, 1, 4) + of(string.ascii_lowercase, 3, 6)))()
            name = r.choice(("password", "passwd", "pwd", "secret", "db_password", "DB_PASS", "client_secret"))
        if form > 0.9:
            name = f"{r.choice(('AWS', 'STRIPE', 'SERVICE_ACCOUNT', 'GITHUB_ACTIONS', 'DATABASE'))}_{r.choice(('SECRET_ACCESS_KEY', 'SECRET_TOKEN', 'API_KEY', 'PASSWORD', 'AUTH_TOKEN'))}"
        return f"{prose()} {name}{r.choice((' = ', '=', ': ', ' := '))}{quote}", value, f"{quote} {prose(2)}"

    def plain() -> tuple[str, str, str]:
        kind = r.randint(0, 11)
        hexes = "0123456789abcdef"
        if kind <= 1:
            return f"{prose()} ", of(string.digits, 16, 19), f"{r.choice((' ', '. ', ', '))}{prose(2)}"
        if kind == 2:
            quote = r.choice(("", '"'))
            return f"{prose()} {r.choice(PLAIN_WORDS)}{r.choice((' ', ': ', '=', ' = '))}{quote}", of(hexes, r.choice((32, 40, 64))), f"{quote} {prose(2)}"
        if kind == 3:
            return f"{prose()} {r.choice(('id ', 'uuid ', ''))}", "-".join(of(hexes, k) for k in (8, 4, 4, 4, 12)), f" {prose(2)}"
        if kind == 4:
            return f"{prose()} https://www.{of('abcdef', 5)}.org/", "/".join(r.choice(PATH_PARTS) + of(string.digits, 0, 4) for _ in range(4)), f".html {prose(2)}"
        if kind == 5:
            return f"{prose()} {r.choice(('', 'token = ' + chr(34), 'api_key: '))}", r.choice(("your_api_key_here", "example-token-value-0", "xxxxxxxxxxxxxxxxxxxxxxxx", "changeme_changeme_123", "0000000000000000000000", "placeholder-secret-here")), f"{prose(2)}"
        if kind == 6:
            word = fragments(5, 12) or "understandingthat"
            return f"{prose()} ", r.choice((word, word.upper())), f"{r.choice((' ', '. ', '!! '))}{prose(2)}"
        if kind == 7:
            return f"{prose()} ", "-".join(r.choice(PATH_PARTS) for _ in range(4)) + f"-{r.randint(1, 2030)}", f" {prose(2)}"
        if kind == 8:
            return f"{prose()} {r.choice((of('abcdehnrs', 3, 8), 'note', 'time', 'class', 'width', 'see', 'content'))}{r.choice((': ', '=', ' = ', ': ' + chr(34), '=' + chr(34), ' > '))}", r.choice((lambda: of("etaoinshrdlu", 8, 20), lambda: fragments(4, 6) or "something", lambda: of(string.digits, 8, 15), lambda: f"{r.choice(PATH_PARTS)}-{r.choice(PATH_PARTS)}.{of('ab', 2)}", lambda: of("etaoinshrdlu", 8, 14) + r.choice("!?%*")))(), f"{r.choice((' ', chr(34), '. '))}{prose(2)}"
        if kind == 9:
            return f"{prose()} {r.choice(('the', 'a', 'our'))} {r.choice(('token', 'secret', 'password', 'key'))} {prose(2)} ", fragments(6, 10) or "understandingthat", f"{r.choice((' ', '. ', ', '))}{prose(2)}"
        if kind == 10:  # a long name before its value
            return f"{prose()} ", "_".join(r.choice(("SERVICE", "ACCOUNT", "SECRET", "ACCESS", "TOKEN", "CLIENT", "PRIVATE", "password", "token", "default", "database")) for _ in range(r.randint(3, 4))), f"{r.choice(('=', ' = ', ': '))}{of(chars, 20)}"
        return f"{prose()} {r.choice(('', '- ', '| '))}", r.choice("-=_+") * r.randint(16, 60), f" {prose(2)}"

    return [((f := secret() if i % 2 else plain())[0][-BEFORE:], f[1], f[2][:AFTER], i % 2) for i in range(n)]


class Forest:
    """Classification trees on bootstrapped rows and a random part of the features at each cut."""

    def __init__(self, x: np.ndarray, y: np.ndarray, names: list[str], words: tuple[str, ...] = (), seed: int = 5):
        self.names, self.words, self.chance = names, words, np.random.default_rng(seed)
        self.trees = []
        for _ in range(TREES):
            rows = self.chance.integers(0, len(y), len(y))
            self.trees.append(self._grow(x[rows], y[rows], DEPTH))

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int):
        share = float(y.mean()) if len(y) else 0.0
        if not depth or len(y) < 2 * LEAST or share in (0.0, 1.0):
            return share
        best = (1e-9, None, None)
        gini = share * (1 - share)
        for f in self.chance.permutation(x.shape[1])[: max(3, x.shape[1] // 2)]:
            values = np.unique(x[:, f])
            cuts = (values[1:] + values[:-1]) / 2
            for cut in cuts if len(cuts) <= 24 else np.quantile(cuts, np.linspace(0.02, 0.98, 24)):
                left = x[:, f] <= cut
                n = int(left.sum())
                if min(n, len(y) - n) < LEAST:
                    continue
                p, q = y[left].mean(), y[~left].mean()
                gain = gini - (n * p * (1 - p) + (len(y) - n) * q * (1 - q)) / len(y)
                if gain > best[0]:
                    best = (gain, f, float(cut))
        if best[1] is None:
            return share
        left = x[:, best[1]] <= best[2]
        return (int(best[1]), best[2], self._grow(x[left], y[left], depth - 1), self._grow(x[~left], y[~left], depth - 1))

    def predict(self, row) -> float:
        total = 0.0
        for tree in self.trees:
            while isinstance(tree, tuple):
                tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
            total += tree
        return total / len(self.trees)

    def sql(self, prefix: str) -> str:
        """The mean over trees, over columns named as the features."""

        def case(tree) -> str:
            if not isinstance(tree, tuple):
                return f"{tree!r}D"
            return f"CASE WHEN {prefix}{self.names[tree[0]]} <= {tree[1]!r}D THEN {case(tree[2])} ELSE {case(tree[3])} END"

        return "(" + " + ".join(case(t) for t in self.trees) + f") / {len(self.trees)}D"


def feature_struct(c: str, b: str, a: str, words: tuple[str, ...] = ()) -> str:
    """SQL of the struct of features of a candidate given by three names; words are plain letters."""
    import re

    names = {"c": c, "b": b, "a": a}
    parts = []
    for name, sql in FEATURES.items():
        pieces = re.split(r"('(?:[^'\\]|\\.)*')", sql)  # names inside string literals stay
        sql = "".join(p if k % 2 else re.sub(r"\b([abc])\b", lambda m: names[m[1]], p) for k, p in enumerate(pieces))
        parts.append(f"'{name}', CAST({sql.replace('__WORDS__', '|'.join(words) or '(?!)')} AS DOUBLE)")
    return f"named_struct({', '.join(parts)})"


def dictionary(docs: DataFrame, most: int = WORDS) -> tuple[str, ...]:
    """The words of some letters that most documents hold, longest first; counted over all documents."""
    low, high = WORD_LENGTHS
    words = F.expr(f"array_distinct(filter(split(lower(text), '[^a-z]+'), w -> length(w) BETWEEN {low} AND {high}))")
    held = docs.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    found = [r["word"] for r in held.orderBy(F.desc("n"), "word").limit(most).collect()]
    return tuple(sorted(found, key=lambda w: (-len(w), w)))


def train(spark: SparkSession, findings: list[tuple[str, str, str, int]] | None = None, words: tuple[str, ...] = ()) -> Forest:
    """A forest from labelled findings (before, candidate, after, label); at most TRAIN_ROWS of them are drawn."""
    findings = findings or labelled_findings()
    if len(findings) > TRAIN_ROWS:
        findings = random.Random(1).sample(findings, TRAIN_ROWS)
    rows = json.dumps([{"k": k, "b": b, "c": c, "a": a, "y": y} for k, (b, c, a, y) in enumerate(findings)])
    table = spark.range(1).select(F.explode(F.from_json(F.lit(rows), "array<struct<k:int,b:string,c:string,a:string,y:int>>")).alias("r")).select("r.*")
    made = table.select("k", "y", F.expr(feature_struct("c", "b", "a", words)).alias("f")).select("k", "y", "f.*").orderBy("k").collect()
    x = np.array([[r[name] for name in FEATURES] for r in made], np.float64)
    return Forest(x, np.array([r["y"] for r in made]), list(FEATURES), words)


def scanned(docs: DataFrame, forest: Forest) -> tuple[DataFrame, str, str, str]:
    """docs with three more columns, and their names: the text between candidates, the candidates, and {i, score} of the confirmed."""
    pieces, found, secrets = free_names(docs.columns, "pieces", "found", "secrets")
    pattern = CANDIDATE.replace("\\", "\\\\").replace("'", "\\'")
    cut = docs.withColumn(found, F.expr(f"regexp_extract_all(text, '{pattern}', 0)")).withColumn(pieces, F.expr(f"split(text, '{pattern}', -1)"))
    # The context may reach over neighbouring candidates, each of SHORTEST characters and one between at least.
    back, ahead = -(-BEFORE // (SHORTEST + 1)), -(-AFTER // (SHORTEST + 1))
    before = f"right(concat_ws('', transform(sequence(greatest(i - {back}, 0), i), j -> concat(right(if(j = 0, '', {found}[j - 1]), {BEFORE}), right({pieces}[j], {BEFORE})))), {BEFORE})"
    after = f"left(concat_ws('', transform(sequence(i + 1, least(i + {ahead}, size({found}))), j -> concat(left({pieces}[j], {AFTER}), if(j < size({found}), left({found}[j], {AFTER}), '')))), {AFTER})"
    rows = f"transform({found}, (c, i) -> named_struct('i', i, 'c', c, 'b', {before}, 'a', {after}))"
    scored = cut.withColumn(secrets, F.expr(rows)).withColumn(secrets, F.expr(f"transform({secrets}, x -> named_struct('i', x.i, 'f', {feature_struct('x.c', 'x.b', 'x.a', forest.words)}))"))
    scored = scored.withColumn(secrets, F.expr(f"transform({secrets}, x -> named_struct('i', x.i, 'score', {forest.sql('x.f.')}))"))
    return scored.withColumn(secrets, F.expr(f"filter({secrets}, x -> x.score >= {CONFIRMED}D)")), pieces, found, secrets


def findings(docs: DataFrame, forest: Forest | None = None) -> DataFrame:
    """doc_id, start, length, secret_sha256 and score of each confirmed secret."""
    forest = forest or train(docs.sparkSession, words=dictionary(docs))
    hits, pieces, found, secrets = scanned(docs.select("doc_id", "text"), forest)
    # One row for each candidate of such a document, numbers and the confirmed candidates only; a running sum places them.
    # The number of the row also keeps the condition above the projections: below them it would cut the text again and again.
    lengths = hits.withColumn("row", F.monotonically_increasing_id()).where(F.size(secrets) > 0).select(
        "doc_id",
        "row",
        F.expr(f"map_from_entries(transform({secrets}, x -> struct(x.i, x.score)))").alias("scores"),
        F.posexplode(F.arrays_zip(F.transform(pieces, F.length).alias("gap"), F.col(found).alias("found"))).alias("i", "r"),
    )
    rows = lengths.select("doc_id", "row", "i", F.col("r.gap").alias("gap"), F.length("r.found").alias("length"), F.expr("scores[i]").alias("score"), F.when(F.expr("scores[i] IS NOT NULL"), F.sha2(F.col("r.found").cast("binary"), 256)).alias("secret_sha256"))
    order = Window.partitionBy("row").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("end", F.sum(F.col("gap").cast("long") + F.coalesce("length", F.lit(0))).over(order))
    return placed.where("score IS NOT NULL").select("doc_id", (F.col("end") - F.col("length")).cast("long").alias("start"), F.col("length").cast("long").alias("length"), "secret_sha256", F.round("score", 9).alias("score"))


def redact(docs: DataFrame, forest: Forest | None = None, mask: str = "[secret]") -> DataFrame:
    """docs with every confirmed secret replaced by the mask; columns as they were."""
    forest = forest or train(docs.sparkSession, words=dictionary(docs))
    hits, pieces, found, secrets = scanned(docs, forest)
    (at,) = free_names(hits.columns, "at")
    hits = hits.withColumn(at, F.expr(f"map_from_entries(transform({secrets}, x -> struct(x.i, true)))"))
    shown = F.expr(f"transform({found}, (c, i) -> CASE WHEN {at}[i] THEN '{mask}' ELSE c END)")
    whole: Column = F.array_join(F.zip_with(pieces, shown, lambda p, c: F.concat(p, F.coalesce(c, F.lit("")))), "")
    text = F.when(F.size(secrets) > 0, whole).otherwise(F.col("text"))
    return hits.withColumn("text", text).select(*(f"`{c}`" for c in docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return findings(read(spark, sf_dir, "documents"))
