"""Personal data: fixed forms, and a contextual extraction bootstrapped from them."""

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import row_key, stored

KINDS = ("email", "ip", "card", "phone", "id")

# The fixed forms. Each is written so that a scan is linear: it begins only where a run begins.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
TOKEN = re.compile(r"[A-Za-z0-9_-]+")
AFTER = re.compile(r"[\s\"').,;:\]]*([^\W\d_]+)")
IN_TOKEN = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-")
#: Keys that each shape of a token is dealt over: there are few shapes, and every value has one.
SALTS = 64

SPAN = "struct<kind:string,start:int,stop:int>"
FOUND = f"base array<{SPAN}>, seeds array<struct<value:string,patterns:array<string>>>, others array<struct<start:int,stop:int,value:string,patterns:array<string>>>"


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str):
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            done = match.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, stop) of the fixed forms in code points, by kind, then start; leftmost, non-overlapping per kind."""
    spans = [("email", s, e) for s, e in _emails(text)] if "@" in text else []
    if DIGIT.search(text):
        spans += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and _luhn(d):
                spans.append(("card", m.start(), m.end()))
        if "+" in text:
            spans += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return spans


def _shape(token: str) -> str:
    letters = {"u" if c.isupper() else "l" for c in token if c.isalpha()}
    return f"S:{''.join(sorted(letters)) or 'd'}{len(token)}"


def _gap_left(text: str, at: int) -> int:
    """Where the spaces, quotes and brackets before ``at`` begin."""
    while at and (text[at - 1] in "\"'([" or text[at - 1].isspace()):
        at -= 1
    return at


def _context(text: str, start: int, stop: int) -> list[str]:
    """The word before, with a mark between, and the word after; both whole, at any distance over spaces and quotes."""
    patterns = []
    at = _gap_left(text, start)
    mark = text[at - 1] if at and text[at - 1] in ":=#" else ""
    stop_word = _gap_left(text, at - len(mark))
    at = stop_word
    while at and text[at - 1].isalnum() and not text[at - 1].isdecimal():
        at -= 1
    if at < stop_word:
        patterns.append(f"L:{text[at:stop_word].lower()}{mark}")
    if m := AFTER.match(text, stop):
        patterns.append(f"R:{m[1].lower()}")
    return patterns


def _others(text: str, taken: list[tuple[int, int]]):
    """Tokens that may be identifiers, outside the fixed forms: 8 characters or more, four of them digits."""
    at, i = 0, 0
    while m := DIGIT.search(text, at):
        while i < len(taken) and taken[i][1] <= m.start():
            i += 1
        if i < len(taken) and taken[i][0] <= m.start():
            at = taken[i][1]
            continue
        start = m.start()
        while start > at and text[start - 1] in IN_TOKEN:
            start -= 1
        stop = TOKEN.match(text, m.start()).end()
        at = stop
        token = text[start:stop]
        inside = i < len(taken) and taken[i][0] < stop
        if len(token) >= 8 and sum("0" <= c <= "9" for c in token) >= 4 and not inside:
            yield start, stop, token.lower(), [*_context(text, start, stop), _shape(token)]


def _scan(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
    kind = pa.struct([("base", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))),
                      ("seeds", pa.list_(pa.struct([("value", pa.string()), ("patterns", pa.list_(pa.string()))]))),
                      ("others", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("value", pa.string()), ("patterns", pa.list_(pa.string()))])))])
    nothing = {"base": [], "seeds": [], "others": []}
    for column in columns:
        out = []
        for i in range(len(column)):
            text = column[i].as_py()
            if not text or not ("@" in text or DIGIT.search(text)):
                out.append(nothing)
                continue
            base = base_spans(text)
            taken, done = [], 0
            for s, e in sorted((s, e) for _, s, e in base):
                if e > done:
                    taken.append((max(s, done), e))
                    done = e
            out.append(
                {
                    "base": [{"kind": k, "start": s, "stop": e} for k, s, e in base],
                    "seeds": [{"value": text[s:e].lower(), "patterns": _context(text, s, e)} for _, s, e in base],
                    "others": [{"start": s, "stop": e, "value": v, "patterns": p} for s, e, v, p in _others(text, taken)],
                }
            )
        yield pa.array(out, kind)


def bootstrap(found: DataFrame, rounds: int = 3, support: int = 3, least: float = 0.6) -> DataFrame:
    """Values held to be identifiers: (value, confidence), from columns seeds and others of ``found``.

    The graph joins distinct values to their patterns: the word before, the word after and the shape
    of the token. Seeds have confidence 1. In each round a pattern's confidence is the sum of the
    confidences of its values over their number plus one, and a value's confidence the highest of
    its patterns that have ``support`` values or more. Rounds are joins and sums in Spark.
    """
    seeds = found.select(F.explode("seeds").alias("x")).select("x.value", F.explode("x.patterns").alias("pattern")).distinct()
    others = found.select(F.explode("others").alias("x")).select("x.value", F.explode("x.patterns").alias("pattern")).distinct()
    shape = F.col("pattern").startswith("S:")
    edges = stored(others.withColumn("salt", F.when(shape, F.pmod(F.xxhash64("value"), F.lit(SALTS)).cast("int")).otherwise(0)), "pii-edges")
    sizes = stored(
        edges.select("pattern", F.lit(0).alias("seed"))
        .unionByName(seeds.select("pattern", F.lit(1).alias("seed")))
        .groupBy("pattern")
        .agg(F.sum("seed").alias("n_seed"), F.count(F.lit(1)).alias("n"))
        .where((F.col("n") > F.col("n_seed")) & (F.col("n") >= support)),
        "pii-patterns",
    )
    values = None
    for _ in range(rounds):
        gained = (
            edges.join(values, "value").groupBy("pattern").agg(F.sum("confidence").alias("gained"))
            if values is not None
            else sizes.select("pattern", F.lit(0.0).alias("gained"))
        )
        patterns = sizes.join(gained, "pattern", "left").select(
            "pattern", ((F.col("n_seed") + F.coalesce("gained", F.lit(0.0))) / (F.col("n") + 1)).alias("p")
        )
        patterns = patterns.withColumn("salt", F.explode(F.when(shape, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
        values = stored(edges.join(patterns, ["pattern", "salt"]).groupBy("value").agg(F.max("p").alias("confidence")), "pii-values")
    return values.where(F.col("confidence") >= least)


def located(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents as _row with _base and _spans: arrays of (kind, start, stop), by kind, then start.

    _base holds the fixed forms, _spans these and the identifiers that the bootstrap discovers (kind
    ``id``). Offsets are code points, stops are exclusive. Null and empty texts have none. A row's
    spans depend on its text and on the counts over all rows; equal rows get equal spans.
    """
    key = row_key(id_col, text_col)
    scan = F.arrow_udf(_scan, f"struct<{FOUND}>", F.ArrowUDFType.SCALAR_ITER)
    rows = docs.select(F.struct("*").alias("_row"), key.alias("_key"), scan(F.col(text_col)).alias("_f"))
    # Only what was found is kept: the text itself is read again when it is needed.
    found = stored(rows.select("_key", "_f.*").where(F.size("_f.base") + F.size("_f.others") > 0).dropDuplicates(["_key"]), "pii-found")
    values = bootstrap(found, **options)
    more = (
        found.select("_key", F.explode("others").alias("x"))
        .select("_key", "x.start", "x.stop", "x.value")
        .join(values, "value")
        .groupBy("_key")
        .agg(F.sort_array(F.collect_list(F.struct(F.lit("id").alias("kind"), "start", "stop"))).alias("more"))
    )
    spans = found.select("_key", "base").join(more, "_key", "left")
    none = F.array().cast(f"array<{SPAN}>")
    keyed = docs.select(F.struct("*").alias("_row"), key.alias("_key"))
    return keyed.join(spans, "_key", "left").select(
        "_row", F.coalesce("base", none).alias("_base"), F.concat(F.coalesce("base", none), F.coalesce("more", none)).alias("_spans")
    )


def written(spans: Column) -> Column:
    """Spans as text: kind:start:stop, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["stop"].cast("string"))), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; of overlapping spans the first stands."""
    ordered = F.array_sort(F.transform(spans, lambda x: F.struct(x["start"], (-x["stop"]).alias("back"), x["kind"])))
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def put(acc, x):
        stop = -x["back"]
        inside = x["start"] < acc["at"]
        before = F.substring(text, acc["at"] + 1, x["start"] - acc["at"])
        return F.struct(
            F.when(inside, acc["out"]).otherwise(F.concat(acc["out"], before, F.lit("<"), x["kind"], F.lit(">"))).alias("out"),
            F.greatest(acc["at"], stop).alias("at"),
        )

    done = F.aggregate(ordered, start, put, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)
