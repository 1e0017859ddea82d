"""Fill-in-middle transformation of documents by lines, in Arrow compute functions per batch.

1. Texts are split at line breaks into list arrays; a unit is a line with its break. Flattened,
   every unit knows its text (parent index) and its place in it (ordinal).
2. Two cuts per document, from its hash, give every unit a role: prefix, middle or suffix.
3. Units are filtered by role, rebuilt into one list per document and joined; the three
   pieces are joined with the markers in the order of the document's form.

Hashes and forms are DataFrame functions. The form depends on the id only, never on the
partitioning, so reruns agree.

Results for special inputs: null and empty texts, texts that hold a marker, and the share
that `rate` leaves out are plain: the text itself, without pieces. A null id hashes as an
empty one. Repeated rows are transformed alike and all stay. A text of any length is one
row of a batch; batches hold `arrow.maxBytesPerBatch` bytes or one row. Columns other than
id and text are not read, so their names cannot clash. An empty table gives an empty one.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from spendgrid.llm.arrays import byte_chunks
from spendgrid.llm.store import pick

MARKS = {"prefix": "<P>", "suffix": "<S>", "middle": "<M>"}
CHUNK_BYTES = 4 << 20


def planned(docs, seed=7, rate=100, spm=50, id_col="doc_id", text_col="text"):
    """doc_id, text, the hashes that place the two cuts, and the form: plain, psm or spm.

    rate: per cent of the documents that are transformed; spm: per cent of these with the
    suffix first.
    """
    rows = pick(docs, doc_id=id_col, text=text_col)
    rows = rows.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    marked = F.lit(False)
    for mark in MARKS.values():
        marked = marked | F.contains("text", F.lit(mark))
    form = F.when((F.col("text") == "") | marked | (h[2] % 100 >= rate), "plain").when(h[3] % 100 < spm, "spm").otherwise("psm")
    return rows.select("doc_id", "text", h[0].alias("h1"), h[1].alias("h2"), form.alias("form"))


def fill_in_middle(docs, seed=7, rate=100, spm=50, id_col="doc_id", text_col="text"):
    """doc_id, n (units), form, prefix_chars, middle_chars, output of every row of docs."""
    rows = planned(docs, seed, rate, spm, id_col, text_col)
    own = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for first, end, data, offsets in byte_chunks(batch.column("text"), CHUNK_BYTES):
                part = batch.slice(first, end - first)
                n, output, sizes = transform(texts_of(data, offsets), part.column("form"), part.column("h1").to_numpy(), part.column("h2").to_numpy())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), n, part.column("form"), *sizes, output], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return rows.mapInArrow(run, f"doc_id {own}, n long, form string, prefix_chars long, middle_chars long, output string")


def texts_of(data, offsets):
    """The texts with these bytes and 64-bit offsets."""
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data)))


def transform(texts, form, h1, h2):
    """Numbers of units, outputs, and the code points of prefix and middle."""
    lines = pc.split_pattern(texts, "\n")
    flat, parent = pc.list_flatten(lines), pc.list_parent_indices(lines).to_numpy()
    counts = pc.list_value_length(lines).to_numpy()
    ordinal = np.arange(len(flat)) - (np.cumsum(counts) - counts)[parent]
    # All lines but the last end in a break; a last one without characters is no unit.
    broken = ordinal < counts[parent] - 1
    real = broken | (pc.binary_length(flat).to_numpy() > 0)
    units = pc.binary_join_element_wise(flat, pc.if_else(pa.array(broken), pa.scalar("\n", pa.large_string()), pa.scalar("", pa.large_string())), pa.scalar("", pa.large_string()))
    n = np.bincount(parent[real], minlength=len(texts))
    cuts = np.stack([h1 % (n + 1), h2 % (n + 1)])
    low, high = cuts.min(0), cuts.max(0)
    role = (ordinal >= low[parent]).astype(np.int8) + (ordinal >= high[parent])
    prefix, middle, suffix = (gathered(units, real & (role == r), parent, len(texts)) for r in range(3))
    plain, spm = pc.equal(form, "plain"), pc.equal(form, "spm")
    p, s, m = MARKS["prefix"], MARKS["suffix"], MARKS["middle"]
    output = pc.if_else(plain, texts, pc.if_else(spm, joined(s, suffix, p, prefix, m, middle), joined(p, prefix, s, suffix, m, middle)))
    none = pa.scalar(None, pa.int64())
    sizes = [pc.if_else(plain, none, pc.utf8_length(x).cast(pa.int64())) for x in (prefix, middle)]
    return pa.array(n, pa.int64()), output.cast(pa.string()), sizes


def gathered(units, chosen, parent, rows):
    """The chosen units of every text, rebuilt into lists and joined."""
    ends = np.cumsum(np.bincount(parent[chosen], minlength=rows))
    lists = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int64()), units.filter(pa.array(chosen)))
    return pc.binary_join(lists, pa.scalar("", pa.large_string()))


def joined(*pieces):
    scalars = [pa.scalar(x, pa.large_string()) if isinstance(x, str) else x for x in pieces]
    return pc.binary_join_element_wise(*scalars, pa.scalar("", pa.large_string()))


def restored(rows, keep=("doc_id",)):
    """The columns to keep and text, rebuilt from the output and form of fill_in_middle."""
    from pyspark.sql.types import StringType, StructField, StructType

    chosen = rows.select(*keep, "form", "output")
    schema = StructType([*chosen.schema.fields[: len(keep)], StructField("text", StringType())])

    def run(batches):
        for batch in batches:
            for first, end, data, offsets in byte_chunks(batch.column(len(keep) + 1), CHUNK_BYTES):
                part = batch.slice(first, end - first)
                text = rebuilt(texts_of(data, offsets), part.column(len(keep)))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], text], schema.names)

    return chosen.mapInArrow(run, schema)


def rebuilt(output, form):
    """The texts. A text with pieces holds no marker, so each marker's first place is its only one."""
    text = output
    p, s, m = MARKS["prefix"], MARKS["suffix"], MARKS["middle"]
    for name, order in (("psm", (p, s, m)), ("spm", (s, p, m))):
        own = pc.equal(form, name)
        if not pc.any(own).as_py():
            continue
        cut, pieces = output.filter(own), []
        for mark in order:
            halves = pc.split_pattern(cut, mark, max_splits=1)
            pieces.append(pc.list_element(halves, 0))
            cut = pc.list_element(halves, 1)
        pieces = [*pieces[1:], cut]  # nothing stands before the first marker
        if name == "spm":
            pieces = [pieces[1], pieces[2], pieces[0]]
        else:
            pieces = [pieces[0], pieces[2], pieces[1]]
        text = pc.replace_with_mask(text, own, joined(*pieces))
    return text.cast(pa.string())
