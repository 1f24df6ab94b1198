"""Conversation repair, filter audit and exact dedup against plain versions, and on odd tables."""

import hashlib
import random
import re
import zlib
from functools import lru_cache
from itertools import permutations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from biomesheaf.llm import catalog, exact, filters, turns
from checks.compare import DATA

SMALL = f"{DATA}/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CONV = "conv_id long, turn long, role string, text string"
BLANK = re.compile(r"[\x20\x09-\x0D]")
LETTERS = {1: "a", 21: "u", 19: "s", 0: "x"}


@lru_cache(None)
def cheapest(codes):
    """(cost, audit) by trying all edits over the states of the grammar, audits told apart as text."""

    @lru_cache(None)
    def on(i, state, put_in):
        found = [(0, "")] if i == len(codes) and state in ("start", "after a") else []
        after = {"start": "su", "after s": "u", "after a": "u", "after u": "a"}[state]
        if i < len(codes):
            cost, audit = on(i + 1, state, 0)
            found.append((4 + cost, "D" + audit))
            role, fault = LETTERS[codes[i] >> 2], codes[i] & 3
            for x in after if fault != 2 else "":
                if x == role or x in "ua":
                    cost, audit = on(i + 1, f"after {x}", 0)
                    found.append((3 * fault + 3 * (x != role) + cost, ("K" if x == role else "R") + audit))
        if put_in < 4:
            for x in after.replace("s", ""):
                cost, audit = on(i, f"after {x}", put_in + 1)
                found.append((3 + cost, "I" + audit))
        return min(found, default=(10**9, ""))

    return on(0, "start", 0)


def plain_repairs(rows):
    """The contract row by row: rows are (conv_id, turn, role, text)."""
    by = {}
    for conv, turn, role, text in rows:
        kept = by.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        role = "user" if kind == 4 else role
        kept += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, kept in by.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, codes, count = set(), bytearray(), {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in kept:
            bare = BLANK.sub("", text)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else None if bare[-1] in ".!?" else "truncated"
            seen.add((role, text))
            if fault:
                count[fault] += 1
            letter = {"a": 1, "u": 21, "s": 19}.get(role[:1], 0)
            codes.append(4 * letter + {None: 0, "truncated": 1}.get(fault, 2))
        told = [t for t, _, _ in kept if t is not None]
        gaps = max(told) - min(told) + 1 - len(set(told)) if told else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:], strict=False))
        cost, audit = cheapest(bytes(codes))
        length, at, left, whole = len(audit) - audit.count("D"), 0, iter(kept), []
        for x in audit:
            row = None if x == "I" else next(left)
            if x == "D":
                continue
            given = ("assistant", "user")[(length - at) % 2 == 0]
            whole.append(f"{row[1] if x == 'K' else given}:{row[2] if row else ''}")
            at += 1
        out[conv] = (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(whole).encode()).hexdigest())
    return out


def told(df):
    return {r[0]: tuple(r[1:]) for r in df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()}


def test_alignment_equals_trying_all_edits():
    rng = random.Random(3)
    for _ in range(1500):
        codes = bytes(4 * rng.choice([1, 21, 19, 0, 1, 21]) + rng.choice([0, 0, 0, 1, 2]) for _ in range(rng.randrange(11)))
        for piece in (turns.PIECE, 4, 1):
            assert turns._aligned(codes, piece) == cheapest(codes)


def test_long_conversations_are_the_same_in_pieces():
    rng = random.Random(5)
    codes = bytes(4 * (rng.choice([1, 21, 19, 0]) if rng.random() < 0.2 else (21, 1)[i % 2]) + (rng.choice([1, 2]) if rng.random() < 0.15 else 0) for i in range(1500))
    assert turns._aligned(codes, 1500) == turns._aligned(codes, 100)


def test_repair_equals_plain_version(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert told(catalog.QUERIES["op11_conversation_repair"](spark, SMALL)) == plain_repairs(rows)


def odd_conversations(spark):
    long = " ".join(f"w{i}" for i in range(50_000)) + "."
    rows = [(c, t, rng_role, text) for c in range(3, 40) for t, rng_role, text in ((0, "system", "Be kind."), (1, "user", f"a{c}"), (1, "user", f"b{c}!"), (None, "assistant", "no turn?"), (9, None, None))]
    rows += [(None, None, None, None), (None, 3, "user", "x."), (1, 0, "", "odd role."), (1, 1, "robot", "r."), (1, 1, "robot", "r."), (2, 5, "user", long), (2, 6, "assistant", " \t\n"), (50, None, "user", "q?")]
    rows += [(60, t, ("assistant", "user")[t % 2], f"t{t % 7}") for t in range(300)] + [(61, 0, "user", "same.")] * 30
    return rows


def test_repair_of_odd_rows(spark):
    rows = odd_conversations(spark)
    df = spark.createDataFrame(rows, CONV).withColumns({"kind": F.lit("x"), "fault": F.lit("y"), "sha": F.lit(1), "cost": F.lit(2)})
    assert told(turns.audits(turns.damaged(df))) == plain_repairs(rows)
    assert turns.audits(turns.damaged(df.limit(0))).collect() == []
    written = {}
    for r in sorted(turns.repaired(turns.damaged(df)).where("conv_id is not null and edit <> 'D'").collect(), key=lambda r: (r.conv_id, r.position)):
        written.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    want = plain_repairs(rows)
    assert all(hashlib.sha256("\n".join(x).encode()).hexdigest() == want[c][-1] for c, x in written.items())


def test_all_rows_dropped_is_an_empty_conversation(spark):
    gone = next(c for c in range(10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(gone, 0, "user", "Hello.")], CONV)
    assert told(turns.audits(turns.damaged(df))) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def plain_audit(docs, labels):
    """All orders walked through row by row."""
    good, toxic = ({i for i, *x in labels if i is not None and x[k] == 1} for k in (0, 1))
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    parts = {}
    for i, text, source in docs:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > first[t]}
        parts.setdefault(source or "", []).append(({f for f in fails if fails[f]}, i in good, i in toxic))
    out, shares = {}, {}
    for part, rows in parts.items():
        for order in permutations("ABCDE"):
            left = rows
            for k, f in enumerate(order):
                gone, left = [r for r in left if f in r[0]], [r for r in left if f not in r[0]]
                failing = sum(f in r[0] for r in rows)
                out[part, "".join(order), k + 1] = (len(left), len(gone), failing - len(gone), sum(r[0] == {f} for r in rows), sum(r[1] for r in gone), sum(r[2] for r in gone))
                shares[part, f] = shares.get((part, f), 0) + len(gone)
    return {k: (*v, shares[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_filter_audit_of_odd_rows(spark):
    rows = [(i, t, s) for i, (t, s) in enumerate([(None, None), ("", ""), ("A B C D", "x"), ("a # b", "x"), ("a # b", "y"), ("one two " * 60, "x"), (" ".join(f"w{k}" for k in range(80)), "y"), ("A" * 9 + " b" * 80, None), ("é|" * 60, "x")])]
    rows += [(None, "a # b", "x"), (3, "a # b", "x"), (3, "a # b", "y"), (None, None, "y"), (20, " ".join(f"v{k}" for k in range(40_000)), "y"), (21, rows[6][1], "y"), (22, rows[6][1], "x")]
    marks = [(3, 1, 0), (3, 0, 1), (None, 1, 1), (6, 1, None), (21, None, 1), (22, 1, 1), (99, 1, 1)]
    docs = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], DOCS).withColumns({c: F.lit(1) for c in ("id", "part", "mask", "good", "n", "digest", "fails", "quality")})
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = {(r.part, r.filter_order, r.step): tuple(r[3:]) for r in filters.audit(filters.failure_counts(docs, labels)).collect()}
    assert got == plain_audit(rows, marks)
    assert filters.audit(filters.failure_counts(docs.limit(0), labels)).collect() == []
    assert len(filters.audit(filters.failure_counts(docs, labels.limit(0))).collect()) == len(got)


def test_potentials_give_the_shapley_value(spark):
    removed = [0, 5, 2, 6]  # v of {}, {0}, {1}, {0, 1}
    got = spark.range(1).select(filters._potentials(F.array(*[F.lit(x).cast("long") for x in removed]), 2)).first()[0]
    assert got == [0, 5, 2, 6 + 5 + 2]


def plain_copies(rows):
    groups, out = {}, []
    for i, text in rows:
        groups.setdefault(BLANK.sub("", text or ""), []).append((-len(text or ""), i is None, i))
    for bare, group in groups.items():
        order = sorted(group, key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(i, order[0][2], len(group), k == 0, hashlib.sha256(bare.encode()).hexdigest()) for k, (_, _, i) in enumerate(order)]
    return sorted(out, key=str)


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_exact_copies_of_odd_rows(spark, partitions):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "a b"), (5, "ab"), (6, "a\x0bb "), (6, "a\x0bb "), (None, "a  b   "), (None, None), (None, "alone"), (7, long), (8, long + "\r"), (9, "é b"), (10, "a\x1fb"), (11, "A b")]
    rows += [(100 + i, "x y" if i % 3 else f"t{i % 50} {i}") for i in range(600)]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS).withColumns({c: F.lit(1) for c in ("id", "digest", "row", "rank", "best", "n", "_row")}).repartition(partitions)
    got = [(r.id, r.keep_id, r.group_size, r.kept, bytes(r.digest).hex()) for r in exact.exact_copies(df).collect()]
    assert sorted(got, key=str) == plain_copies(rows)
    stay = sorted(((r.doc_id, r.text) for r in exact.deduplicated(df).collect()), key=str)
    first = {x[4]: x[0] for x in plain_copies(rows) if x[3]}
    assert len(stay) == len(first) and {hashlib.sha256(BLANK.sub("", t or "").encode()).hexdigest(): i for i, t in stay} == first
    assert exact.exact_copies(df.limit(0)).collect() == [] and exact.deduplicated(df).columns == df.columns


def test_runs_of_any_number_of_places_merge_whole(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 900).alias("text")).repartition(13)
    rows = exact._described(docs, "doc_id", "text").select("rank", "digest", "chars", "best", F.lit(1).cast("long").alias("n"))
    for places in (1, 5, 200):
        merged = exact.tree_merged(rows, places).select("best.id", "n").collect()
        assert sorted(r.id for r in merged) == list(range(900)) and {r.n for r in merged} == {5, 6}


def test_runs_go_on_over_batches():
    def batch(rows):
        return pa.RecordBatch.from_pylist([{"rank": 0, "digest": d, "chars": 1, "best": {"row": r}, "n": 1} for d, r in rows], schema=schema)

    schema = pa.schema([("rank", pa.int32()), ("digest", pa.binary()), ("chars", pa.int32()), ("best", pa.struct([("row", pa.int64())])), pa.field("n", pa.int64(), nullable=False)])
    batches = [batch([(b"a", 0), (b"b", 1)]), batch([(b"b", 2)]), batch([]), batch([(b"b", 3), (b"c", 4), (b"c", 5)])]
    got = [(r["digest"], r["best"]["row"], r["n"]) for b in exact._runs(iter(batches)) for r in b.to_pylist()]
    assert got == [(b"a", 0, 1), (b"b", 1, 3), (b"c", 4, 2)]
