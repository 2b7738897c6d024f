"""Personal data: fixed patterns, and contextual extraction bootstrapped from what they find."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from prodseq.llm.batches import over_texts, texts_of
from prodseq.llm.scratch import Scratch, met

#: Fixed: kinds in listed order; the last one is what contexts add.
KINDS = ("email", "ip", "card", "phone", "other")

#: Fixed: characters in front of an @, and what each kind looks like. Digit runs are taken
#: whole, which finds the same spans and never goes back into a run.
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile("[0-9]+")
#: What ends a token, and what ends one that has no blanks within its longest length.
BLANK, MARK = re.compile(r"\s"), re.compile(r"[^\w.+@/#-]")
#: Distinct tokens between two words, none of them known, that make the words a context of other things.
FOREIGN = 3

#: What a candidate is: the digits it needs, its longest length, and the characters of a context word that are compared.
LEAST_DIGITS, LONGEST, CONTEXT = 4, 64, 24


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(place of the kind, start, end) in code points, by kind and start."""
    found = [(0, a, b) for a, b in _emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            found.append((1, *m.span()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            found.append((2, *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((3, *m.span()))
    return found


def _word_before(text: str, at: int) -> str:
    near = text[max(0, at - 2 * CONTEXT) : at].split("\n")[-1].split()
    return near[-1].strip(".,;:!?()|\"'").lower()[-CONTEXT:] if near else ""


def _word_after(text: str, at: int) -> str:
    near = text[at : at + 2 * CONTEXT].split("\n")[0].split()
    return near[0].strip(".,;:!?()|\"'").lower()[:CONTEXT] if near else ""


def _shape(token: str) -> str:
    """Digit runs by their length, letter runs as one letter, everything else as it is."""
    return re.sub(r"[0-9]+", lambda m: f"<{min(20, len(m[0]))}>", re.sub(r"[^\W\d_]+", "a", token))


def _around(text: str, start: int, end: int, stop: re.Pattern) -> tuple[int, int]:
    """The token around some digits, up to characters of ``stop``; more than ``LONGEST`` are not looked at on either side."""
    before = [m.end() for m in stop.finditer(text, max(0, start - LONGEST - 1), start)]
    after = stop.search(text, end, min(len(text), end + LONGEST + 1))
    low = before[-1] if before else max(0, start - LONGEST - 1)
    return low, after.start() if after else min(len(text), end + LONGEST + 1)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[dict]:
    """Places that may hold an identifier: base spans, and other tokens with enough digits."""
    taken = sorted((a, b) for _, a, b in base)
    places = [(a, b, True) for a, b in dict.fromkeys(taken)]
    end, k = 0, 0
    for m in DIGITS.finditer(text):
        if m.start() < end:
            continue
        start, end = _around(text, *m.span(), BLANK)
        if end - start > LONGEST:  # no blanks: go by punctuation
            start, end = _around(text, *m.span(), MARK)
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        if any(a < end for a, _ in taken[k : k + 4]):
            continue
        token = text[start:end]
        trimmed = token.strip("\"'()[]{}<>.,;:!?|*#$%&")
        if len(trimmed) <= LONGEST and sum(map(str.isdigit, trimmed)) >= LEAST_DIGITS:
            begin = start + token.index(trimmed)
            places.append((begin, begin + len(trimmed), False))
    return [
        {"start": a, "end": b, "seed": seed, "instance": text[a : min(b, a + LONGEST)], "before": _word_before(text, a), "after": _word_after(text, b), "shape": _shape(text[a : min(b, a + LONGEST)])}
        for a, b, seed in places
    ]


def _told(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


CANDIDATE = "array<struct<start:int, end:int, seed:boolean, instance:string, before:string, after:string, shape:string>>"


def scan(docs: DataFrame) -> DataFrame:
    """Per (row, id, text) the counts and spans of the base kinds and all candidates, without the text."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("seed", pa.bool_()), *((n, pa.string()) for n in ("instance", "before", "after", "shape"))]))

    def run(batch: pa.RecordBatch) -> dict:
        texts = texts_of(batch)
        spans = [base_spans(t) for t in texts]
        out = {f"n_{name}": pa.array([sum(s[0] == k for s in x) for x in spans], pa.int64()) for k, name in enumerate(KINDS[:4])}
        told = [_told(x) for x in spans]
        out["base"] = pa.array(told)
        out["base_sha256"] = pa.array([hashlib.sha256(t.encode()).hexdigest() for t in told])
        out["candidates"] = pa.array([candidates(t, s) for t, s in zip(texts, spans, strict=True)], kind)
        return out

    counts = ", ".join(f"n_{name} long" for name in KINDS[:4])
    return over_texts(docs, ["row", "id", "text"], run, f"{counts}, base string, base_sha256 string, candidates {CANDIDATE}")


def discover(scanned: DataFrame, scratch: Scratch, least_seeds: int = 3, confident: float = 0.8) -> DataFrame:
    """(row, start, end) of unseen identifiers in contexts that hold known ones.

    A pattern is a word before with the token's shape, a shape with the word after, or both
    words. The graph joins each pattern with the distinct tokens seen in it. Base tokens are
    known identifiers. A token is known to be none if it also stands between two words that
    surround three or more tokens, none of them a base token, most of which share no pattern
    with one. All others are unknown.

    In a round a pattern's trust is the share of known identifiers among its tokens, where
    unknown tokens count only as far as they outnumber the known ones, and one token more is
    counted against it. It is good from ``least_seeds`` known ones and a trust of
    ``confident``. An unknown token is accepted when the chance that not all its good
    patterns are wrong reaches ``confident``; then it is known. Rounds go on until nothing
    new is accepted. Accepted tokens are taken where they stand in a good pattern.
    """
    seen = scanned.select("row", F.explode("candidates").alias("c")).select("row", "c.*")
    key = lambda mark, *parts: F.concat_ws("\x01", F.lit(mark), *parts)
    patterns = F.array(
        F.when(F.col("before") != "", key("before", "before", "shape")),
        F.when(F.col("after") != "", key("after", "shape", "after")),
        F.when((F.col("before") != "") & (F.col("after") != ""), key("both", "before", "after")),
    )
    uses = seen.select("row", "start", "end", "seed", "instance", F.explode(F.array_compact(patterns)).alias("pattern"))
    graph = scratch.write(uses.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "graph")
    between = graph.filter(F.col("pattern").startswith("both\x01"))
    near = graph.join(met(graph.filter("seed").select("pattern").distinct()), "pattern", "left_semi").select("instance").distinct().withColumn("near", F.lit(True))
    contexts = between.join(met(near), "instance", "left").groupBy("pattern").agg(F.count("*").alias("n"), F.max("seed").alias("seed"), F.count("near").alias("near"))
    foreign = contexts.filter((F.col("n") >= FOREIGN) & ~F.col("seed") & (2 * F.col("near") < F.col("n")))
    none = between.join(met(foreign.select("pattern")), "pattern", "left_semi").select("instance").distinct().withColumn("none", F.lit(True))
    known = graph.groupBy("instance").agg(F.max("seed").alias("seed")).join(met(none), "instance", "left")
    state = F.when(F.col("seed"), 1).when(F.col("none"), -1).otherwise(0)
    states = scratch.write(known.select("instance", "seed", state.alias("state")), "states")
    while True:
        rated = graph.select("pattern", "instance").join(met(states), "instance").groupBy("pattern").agg(*(F.count_if(F.col("state") == k).alias(n) for k, n in ((1, "good"), (-1, "bad"), (0, "open"))))
        against = F.col("bad") + F.greatest(F.lit(0), F.col("open") - F.col("good")) + 1
        trusted = rated.withColumn("trust", F.col("good") / (F.col("good") + against))
        good = scratch.write(trusted.filter((F.col("good") >= least_seeds) & (F.col("trust") >= confident)).select("pattern", "trust"), "patterns")
        reached = graph.join(met(good), "pattern").groupBy("instance").agg((1 - F.exp(F.sum(F.log(1 - F.col("trust"))))).alias("reached"))
        accepted = (F.col("state") == 0) & (F.coalesce("reached", F.lit(0.0)) >= confident)
        new = Observation()
        updated = states.join(met(reached), "instance", "left").withColumn("accepted", accepted).observe(new, F.count_if("accepted").alias("n"))
        before, states = states, scratch.write(updated.select("instance", "seed", F.when(F.col("accepted"), 1).otherwise(F.col("state")).alias("state")), "states")
        scratch.drop(before)
        if not _observed(new, states):
            break
    taken = states.filter((~F.col("seed")) & (F.col("state") == 1)).select("instance")
    return uses.filter("NOT seed").join(met(good.select("pattern")), "pattern", "left_semi").join(met(taken), "instance", "left_semi").select("row", "start", "end").distinct()


def _observed(new: Observation, states: DataFrame) -> int:
    """What the write counted; nothing where its plan found the table empty and dropped the count."""
    if states.isEmpty():
        return 0
    return new.get["n"]


def _with_all_spans(numbered: DataFrame, scratch: Scratch) -> DataFrame:
    """Scanned rows with ``spans``: base spans and then those that contexts add."""
    scanned = scratch.write(scan(numbered), "scanned")
    added = discover(scanned, scratch).groupBy("row").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "end"))), lambda s: F.concat_ws(":", F.lit(KINDS[4]), s["start"], s["end"])), ",").alias("added")
    )
    joined = scanned.drop("candidates").join(met(added), "row", "left")
    return joined.withColumn("spans", F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), "added"))


def find_personal_data(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Counts of the base kinds, the digest of their spans and all spans, one row per input row.

    A missing text counts as empty; rows with missing or repeated ids are each scanned, and
    other columns are not read. An empty table gives an empty result. Patterns are scored
    over all documents, so what is added to one text depends on the others; base spans do not.
    """
    scratch = Scratch(docs.sparkSession, "pii")
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return _with_all_spans(numbered, scratch).select(F.col("id").alias(id_column), *(f"n_{name}" for name in KINDS[:4]), "base_sha256", "spans")


def _masked(text: str, spans: str) -> str:
    """The text with each span replaced by its kind; spans that overlap become one."""
    parts = sorted((int(a), int(b), kind) for kind, a, b in (s.split(":") for s in spans.split(",")))
    out, end = [], 0
    for a, b, kind in parts:
        if a >= end:
            out += [text[end:a], f"<{kind}>"]
        end = max(end, b)
    return "".join([*out, text[end:]])


@F.pandas_udf(StringType())
def _mask(texts: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series([t if t is None or not s else _masked(t, s) for t, s in zip(texts, spans, strict=True)], dtype=object)


def mask_personal_data(docs: DataFrame, text_column: str = "text", length_column: str = "n_chars") -> DataFrame:
    """The input rows with personal data in the text replaced by its kind.

    All columns are kept; ``length_column``, where there is one, becomes the new length.
    A missing text stays missing.
    """
    scratch = Scratch(docs.sparkSession, "pii")
    numbered = scratch.write(docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc")), "documents")
    texts = numbered.select("row", F.lit(None).cast("long").alias("id"), F.col(f"doc.{text_column}").alias("text"))
    spans = _with_all_spans(texts, scratch).filter("spans <> ''").select("row", "spans")
    joined = numbered.join(met(spans), "row", "left").select("doc", _mask(F.col(f"doc.{text_column}"), F.coalesce("spans", F.lit(""))).alias("masked"))
    columns = []
    for field in docs.schema.fields:
        if field.name == text_column:
            columns.append(F.col("masked").alias(field.name))
        elif field.name == length_column:
            columns.append(F.coalesce(F.length("masked").cast(field.dataType), F.col("doc")[field.name]).alias(field.name))
        else:
            columns.append(F.col("doc")[field.name].alias(field.name))
    return joined.select(*columns)
