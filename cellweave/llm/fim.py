"""Fill-in-the-middle by overlapping-chunk decomposition.

A text is cut at two ranks: after so many units the prefix ends, after so many
the middle. Where a unit begins is told by a predicate on two neighbouring
bytes, so a chunk needs just one byte of what stands before it:

1. The bytes of an Arrow batch are dealt into chunks of CHUNK bytes that
   overlap by one byte, whatever texts they belong to; a long text is many
   chunks, many short texts share one. The predicate is taken over a whole
   chunk at once, and the units that begin are counted for each text in it.
2. Prefix sums of these counts say how many units begin before each chunk, and
   route both cut ranks of each text to the chunks that own them.
3. Only owning chunks are scanned again, for the byte at which the unit of that
   rank begins.

A text is one value of one row, so it is counted by the task that reads it:
moving its chunks would cost more than counting them. Nothing is shuffled.

Where to cut and what form a text takes come from a hash of its id, so reruns
and other partitions give the same. restore() reads a text back from its output
and form by DataFrame functions; sentinels that could arise where a part and a
sentinel meet are refused, so that this is always exact.

Defined results
  null text      an empty text, plain
  null id        hashed as if its digits were empty
  repeated rows  each is formatted, all alike
  empty table    no rows
  very long text chunks of CHUNK bytes are counted one by one; beside the text and its output a task holds a flag for each byte of one chunk
  other columns  ignored, whatever their names
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import table

CHUNK = 1 << 16
#: Of a hundred texts so many are plain, and of the others so many put the suffix first.
PLAIN, SUFFIX_FIRST = 10, 20
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = "1"


def _space(b: np.ndarray) -> np.ndarray:
    return (b == 32) | ((b >= 9) & (b <= 13))


#: Whether a unit begins at a byte, by it and the byte before. A text's first byte always begins one.
UNITS = {
    "char": lambda before, here: (here & 0xC0) != 0x80,
    "word": lambda before, here: _space(before) & ~_space(here),
    "line": lambda before, here: before == 10,
}


def _begins(data: np.ndarray, low: int, high: int, unit: str) -> np.ndarray:
    """For each byte from low to high, by the chunk that also holds the byte before low: whether a unit begins there."""
    before = data[low - 1 : high - 1] if low else np.concatenate((np.full(1, 10, np.uint8), data[: high - 1]))
    return UNITS[unit](before, data[low:high])


def count_pieces(data: np.ndarray, starts: np.ndarray, unit: str, chunk: int) -> tuple[np.ndarray, np.ndarray]:
    """(begin, units) of each piece, a text's share of a chunk. starts: where texts that aren't empty begin, ascending, from 0 on."""
    begins, counts = [], []
    for low in range(0, len(data), chunk):
        high = min(low + chunk, len(data))
        flags = _begins(data, low, high, unit).astype(np.int64)
        own = starts[np.searchsorted(starts, low) : np.searchsorted(starts, high)]
        flags[own - low] = 1
        at = own if len(own) and own[0] == low else np.concatenate(([low], own))
        begins.append(at)
        counts.append(np.add.reduceat(flags, at - low))
    if not begins:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(begins), np.concatenate(counts)


def locate(data: np.ndarray, offsets: np.ndarray, ranks, unit: str = "char", chunk: int = CHUNK) -> tuple[np.ndarray, np.ndarray]:
    """How many units each text has, and the bytes at which its units of some ranks begin (a rank of all of them: its end).

    offsets: where each text begins in data, and where the last ends. ranks: from the counts to an array of a column a cut.
    """
    lengths = np.diff(offsets)
    starts = offsets[:-1][lengths > 0]
    begin, units = count_pieces(data, starts, unit, chunk)
    before = np.concatenate(([0], np.cumsum(units)))  # units of the batch that begin before each piece
    first, last = np.searchsorted(begin, offsets[:-1]), np.searchsorted(begin, offsets[1:])
    n = before[last] - before[first]
    asked = np.asarray(ranks(n), np.int64).reshape(len(n), -1)
    places = np.repeat(offsets[1:, None], asked.shape[1], axis=1)
    ends = np.concatenate((begin[1:], [len(data)]))
    wanted = before[first][:, None] + asked
    owner = np.searchsorted(before, wanted, side="right") - 1
    for text, cut in np.argwhere(asked < n[:, None]):
        piece = owner[text, cut]
        flags = _begins(data, begin[piece], ends[piece], unit)
        if begin[piece] == offsets[text]:
            flags[0] = True
        places[text, cut] = begin[piece] + np.flatnonzero(flags)[wanted[text, cut] - before[piece]]
    return n, places


def _formatted(batches: Iterator[pa.RecordBatch], unit: str, chunk: int, sentinels: tuple[str, str, str]) -> Iterator[pa.RecordBatch]:
    p, s, m = (x.encode() for x in sentinels)
    for batch in batches:
        texts = batch.column(1)
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        whole = texts.buffers()[2]
        data = np.frombuffer(whole, np.uint8)[offsets[0] : offsets[-1]] if whole is not None else np.empty(0, np.uint8)
        offsets = offsets - offsets[0]
        first, second = (batch.column(k).to_numpy() for k in (3, 4))

        def ranks(n: np.ndarray, first=first, second=second) -> np.ndarray:
            one, two = first % (n + 1), second % (n + 1)
            return np.stack([np.minimum(one, two), np.maximum(one, two)], axis=1)

        n, places = locate(data, offsets, ranks, unit, chunk)
        cuts = ranks(n)
        out = []
        for k, form in enumerate(batch.column(2).to_pylist()):
            low, high = offsets[k], offsets[k + 1]
            if form == "plain":
                out.append(data[low:high].tobytes())
                continue
            one, two = places[k]
            prefix, middle, suffix = data[low:one].tobytes(), data[one:two].tobytes(), data[two:high].tobytes()
            out.append(b"".join((p, prefix, s, suffix, m, middle) if form == "psm" else (s, suffix, p, prefix, m, middle)))
        plain = np.array([f == "plain" for f in batch.column(2).to_pylist()], bool)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n), batch.column(2), pa.array(cuts[:, 0], mask=plain), pa.array(cuts[:, 1] - cuts[:, 0], mask=plain), pa.array(out, pa.binary())],
            names=["__id", "n", "form", "prefix_units", "middle_units", "output"],
        )


def _checked(sentinels: tuple[str, str, str]) -> None:
    firsts = {x[:1] for x in sentinels}
    if "" in firsts or len(set(sentinels)) < 3 or any(c in x[1:] for x in sentinels for c in firsts):
        raise ValueError("sentinels must differ, and the character that one begins with may stand nowhere else in them")


def fill_in_middle(
    docs: DataFrame, id_col: str, text_col: str, unit: str = "char", plain: int = PLAIN, suffix_first: int = SUFFIX_FIRST,
    sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE), seed: str = SEED, chunk: int = CHUNK,
) -> DataFrame:
    """(id, n, form, prefix_units, middle_units, output) of each row; n counts all units. form: plain, psm (prefix, suffix, middle) or spm (suffix first)."""
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {', '.join(UNITS)}, not {unit}")
    _checked(sentinels)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))), 256)

    def number(k: int) -> Column:
        return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint")

    marked = text.contains(sentinels[0]) | text.contains(sentinels[1]) | text.contains(sentinels[2])
    form = F.when((text == "") | marked | (number(2) % 100 >= 100 - plain), "plain").when(number(3) % 100 < suffix_first, "spm").otherwise("psm")
    sent = docs.select(F.col(f"`{id_col}`").alias("__id"), text.cast("binary").alias("__text"), form.alias("__form"), number(0).alias("__h1"), number(1).alias("__h2"))
    kind = docs.schema[id_col].dataType.simpleString()
    made = sent.mapInArrow(partial(_formatted, unit=unit, chunk=chunk, sentinels=sentinels), f"__id {kind}, n bigint, form string, prefix_units bigint, middle_units bigint, output binary")
    return made.select(F.col("__id").alias(id_col), "n", "form", "prefix_units", "middle_units", F.col("output").cast("string").alias("output"))


def restore(output: Column, form: Column, sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text that output was made of."""
    p, s, m = sentinels
    head = F.substring_index(output, m, 1)
    middle = F.substring_index(output, m, -1)
    after_p, after_s = F.substring_index(head, p, -1), F.substring_index(head, s, -1)
    psm = F.concat(F.substring_index(after_p, s, 1), middle, after_s)
    spm = F.concat(after_p, middle, F.substring_index(after_s, p, 1))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def op11_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    """All documents, cut between code points."""
    made = fill_in_middle(table(spark, sf_dir, "documents"), "doc_id", "text")
    return made.select(
        "doc_id",
        "n",
        "form",
        F.col("prefix_units").alias("prefix_chars"),
        F.col("middle_units").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


ORACLE = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS x, sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS d FROM documents),
h AS (SELECT doc_id, x, length(x)::BIGINT AS n, ('0x' || d[1:8])::BIGINT AS h1, ('0x' || d[9:16])::BIGINT AS h2, ('0x' || d[17:24])::BIGINT AS h3, ('0x' || d[25:32])::BIGINT AS h4 FROM t),
f AS (
  SELECT doc_id, x, n, least(h1 % (n + 1), h2 % (n + 1)) AS p, greatest(h1 % (n + 1), h2 % (n + 1)) AS q,
    CASE WHEN x = '' OR contains(x, '{PREFIX}') OR contains(x, '{SUFFIX}') OR contains(x, '{MIDDLE}') OR h3 % 100 >= {100 - PLAIN} THEN 'plain' WHEN h4 % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form
  FROM h),
g AS (SELECT *, substring(x, 1, p) AS a, substring(x, p + 1, q - p) AS b, substring(x, q + 1, n - q) AS c FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN p END AS prefix_chars, CASE WHEN form <> 'plain' THEN q - p END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '{PREFIX}' || a || '{SUFFIX}' || c || '{MIDDLE}' || b ELSE '{SUFFIX}' || c || '{PREFIX}' || a || '{MIDDLE}' || b END) AS output_sha256,
  sha256(x) AS restored_sha256
FROM g
"""
