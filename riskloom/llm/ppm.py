"""Language-model scores by prediction by partial matching.

The model is a byte-context trie of order ``ORDER``: for every context of up to that many
bytes, which symbols followed how often in the training documents. A symbol that its
context has not seen costs an escape (method C: distinct symbols over distinct symbols plus
total) to the next shorter context, where the symbols of the longer one are excluded; below
order 0 all symbols left are equally likely. A-Z are read in lower case, by the trie as by the
words. A text's score is the log10 probability of its
bytes and its end. Beside it stands a unigram word model with add-one counts.

Neither the trie nor the vocabulary is ever whole in one place. Documents fall into blocks
by a hash; a block tells its distinct words and its distinct strings of ``ORDER + 1`` bytes
with their training counts, which are summed to the levels of the trie (tables by string
and by context). Joins along the levels give each distinct string its probability:
exclusion needs only two sums per context. Blocks get back the numbers of what they asked,
one row per block for a string however frequent. Only levels of at most two bytes (65,536
strings) are broadcast.

Defined cases: null text is empty (it has an end); a null id is held in, as are all whose
crc32 does not leave 2; repeated rows count and are scored singly; without training rows
every symbol has the chance 1/256; other columns are ignored; an empty table gives an
empty result. Equal ids get one row each.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import ascii_lower, buckets, flat, held_out, keyed, with_id
from riskloom.session import materialise

ORDER = 4
START, END = 0xFE, 0xFF  # bytes that UTF-8 never has
BLOCK_BYTES = 24 << 20
CHUNK = 2 << 20


def codes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of each document and its end: the byte and its ORDER predecessors as
    one number; and where each document begins among them."""
    size = np.diff(at)
    body = np.full(int(at[-1]) + len(size) * (ORDER + 1), START, np.uint8)
    begin = at[:-1] + np.arange(len(size)) * (ORDER + 1) + ORDER
    body[np.repeat(begin - at[:-1], size) + np.arange(int(at[-1]))] = data
    body[begin + size] = END
    code = np.zeros(max(0, len(body) - ORDER), np.int64)
    for k in range(ORDER + 1):
        code = (code << 8) | body[k : len(body) - ORDER + k]
    real = np.ones(len(code), bool)
    skip = (begin[1:, None] - ORDER - np.arange(1, ORDER + 1)[None, :]).ravel() if len(size) > 1 else np.zeros(0, np.int64)
    real[skip] = False
    return code[real], np.concatenate([[0], np.cumsum(size + 1)])


def _chunks(at: np.ndarray):
    i = 0
    while i < len(at) - 1:
        j = max(i + 1, int(np.searchsorted(at, at[i] + CHUNK, "right")) - 1)
        yield i, j
        i = j


def _tell(table: pa.Table) -> pa.Table:
    """Distinct words and strings of a block with their training counts."""
    block = table.column("block")[0].as_py()
    data, at = flat(table.column("body"))
    train = np.asarray(table.column("train"))
    words: Counter = Counter()
    other: set[bytes] = set()
    found, counts = [], []
    for i, j in _chunks(at):
        part = data[at[i] : at[j]]
        for k in range(i, j):
            own = data[at[k] : at[k + 1]].tobytes().split()
            if train[k]:
                words.update(own)
                words[b""] += 1
            else:
                other.update(own)
                other.add(b"")
        code, begin = codes(part, at[i : j + 1] - at[i])
        learn = np.repeat(train[i:j], np.diff(begin))
        for pick in (learn, ~learn):
            seen, n = np.unique(code[pick], return_counts=True)
            found.append(seen)
            counts.append(n if pick is learn else np.zeros(len(seen), np.int64))
    seen, back = np.unique(np.concatenate(found), return_inverse=True)
    total = np.bincount(back, np.concatenate(counts), len(seen)).astype(np.int64)
    keys = [*words, *(w for w in other if w not in words)]
    n_words = len(keys)
    return pa.table(
        {
            "block": pa.array([block] * (n_words + len(seen)), pa.int32()),
            "word": pa.array([*keys, *[None] * len(seen)], pa.binary()),
            "code": pa.concat_arrays([pa.nulls(n_words, pa.int64()), pa.array(seen, pa.int64())]),
            "n": pa.concat_arrays([pa.array([words.get(w, 0) for w in keys], pa.int64()), pa.array(total, pa.int64())]),
        }
    )


def _score(docs: pa.Table, answers: pa.Table) -> pa.Table:
    """Scores of a block's documents from the numbers it asked for."""
    empty = {"_u": pa.int64(), "n_tokens": pa.int64(), "n_known": pa.int64(), "log_counts": pa.float64(), "score": pa.float64()}
    if not docs.num_rows:
        return pa.table({c: pa.array([], t) for c, t in empty.items()})
    is_word = np.asarray(answers.column("word").combine_chunks().is_valid())
    value = np.asarray(answers.column("value"))
    counts = dict(zip(answers.column("word").filter(pa.array(is_word)).to_pylist(), value[is_word].tolist(), strict=True))
    code = np.asarray(answers.column("code").filter(pa.array(~is_word)))
    order = np.argsort(code)
    code, chance = code[order], value[~is_word][order]
    data, at = flat(docs.column("body"))
    n = docs.num_rows
    tokens, known, logs, score = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
    for i, j in _chunks(at):
        own, begin = codes(data[at[i] : at[j]], at[i : j + 1] - at[i])
        score[i:j] = np.add.reduceat(chance[np.searchsorted(code, own)], begin[:-1])
        for k in range(i, j):
            words = Counter(data[at[k] : at[k + 1]].tobytes().split())
            words[b""] += 1
            times = np.fromiter(words.values(), np.int64, len(words))
            c = np.fromiter(map(counts.__getitem__, words), np.float64, len(words))
            tokens[k], known[k], logs[k] = times.sum(), times[c > 0].sum(), (times * np.log10(c + 1)).sum()
    return pa.table({"_u": docs.column("_u"), "n_tokens": pa.array(tokens), "n_known": pa.array(known), "log_counts": pa.array(logs), "score": pa.array(score)})


def chances(grams: DataFrame) -> DataFrame:
    """(code, value): log10 probability of the last byte after the others, for every row
    of ``grams`` (code, n), learnt from those with n > 0."""
    levels, contexts = {}, {}
    levels[ORDER] = materialise(grams.where("n > 0").select("code", "n"), "level")
    for k in range(ORDER - 1, -1, -1):
        mask = (1 << 8 * (k + 1)) - 1
        levels[k] = materialise(levels[k + 1].groupBy(F.col("code").bitwiseAND(F.lit(mask)).alias("code")).agg(F.sum("n").alias("n")), "level")
    for k in range(ORDER + 1):
        rows = levels[k].select(F.shiftrightunsigned("code", 8).alias("ctx"), "code", "n")
        if k:
            lower = levels[k - 1].select(F.col("code").alias("low"), F.col("n").alias("low_n"))
            rows = rows.withColumn("low", F.col("code").bitwiseAND(F.lit((1 << 8 * k) - 1))).join(F.broadcast(lower) if k <= 2 else lower, "low")
        else:
            rows = rows.withColumn("low_n", F.lit(0))
        contexts[k] = rows.groupBy("ctx").agg(F.sum("n").alias(f"t{k}"), F.count("*").alias(f"d{k}"), F.sum("low_n").alias(f"x{k}"))
    rows = grams.select("code")
    for k in range(ORDER, -1, -1):
        mine = F.col("code").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1))
        rows = rows.withColumn("key", mine).withColumn("ctx", F.shiftrightunsigned(mine, 8))
        level, context = levels[k].select(F.col("code").alias("key"), F.col("n").alias(f"c{k}")), contexts[k]
        rows = rows.join(F.broadcast(level) if k <= 1 else level, "key", "left").join(F.broadcast(context) if k <= 2 else context, "ctx", "left").drop("key", "ctx")
    value = F.lit(0.0)
    told = F.lit(False)
    out_t, out_d = F.lit(0), F.lit(0)
    for k in range(ORDER, -1, -1):
        seen, c = F.col(f"t{k}").isNotNull(), F.col(f"c{k}")
        t, d = F.col(f"t{k}") - out_t, F.col(f"d{k}") - out_d
        cost = F.when(c.isNotNull(), F.log10(c / (t + d))).when(d > 0, F.log10(d / (t + d))).otherwise(0.0)
        value = value + F.when(~told & seen, cost).otherwise(0.0)
        told = told | (seen & c.isNotNull())
        out_t, out_d = F.when(seen, F.col(f"x{k}")).otherwise(0), F.when(seen, F.col(f"d{k}")).otherwise(0)
        names = {"value": value, "told": told, "out_t": out_t, "out_d": out_d}
        rows = rows.withColumns(names)
        value, told, out_t, out_d = (F.col(c) for c in names)
    return rows.select("code", (value - F.when(told, 0.0).otherwise(F.log10(F.lit(256.0) - out_d))).alias("value"))


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int = 7) -> DataFrame:
    """Per document: ``id_col``, held_out, n_tokens, n_known, train_tokens, base_score and score.
    Documents whose crc32(id as text) mod ``parts`` is 2 are held out of training."""
    table, plain = keyed(docs, id_col, text_col)
    texts = table.select("_u", ascii_lower(F.coalesce(text_col, F.lit(""))).cast("binary").alias("body"), (~held_out(id_col, parts)).alias("train"))
    n = buckets(texts, F.length("body"), BLOCK_BYTES)
    texts = texts.withColumn("block", F.pmod(F.xxhash64("_u"), F.lit(n)).cast("int"))
    told = materialise(texts.groupBy("block").applyInArrow(_tell, "block int, word binary, code long, n long"), "told")
    vocabulary = materialise(told.where("word is not null").groupBy("word").agg(F.sum("n").alias("n")), "vocabulary")
    totals = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.when(F.col("n") > 0, 1)).alias("v")).first()
    grams = materialise(told.where("code is not null").groupBy("code").agg(F.sum("n").alias("n")), "grams")
    words = told.where("word is not null").select("block", "word").join(vocabulary, "word")
    strings = told.where("code is not null").select("block", "code").join(chances(grams), "code")
    none = {"word": F.lit(None).cast("binary"), "code": F.lit(None).cast("long")}
    answers = words.select("block", "word", none["code"].alias("code"), F.col("n").cast("double").alias("value")).union(strings.select("block", none["word"].alias("word"), "code", "value"))
    schema = "_u long, n_tokens long, n_known long, log_counts double, score double"
    scored = texts.select("block", "_u", "body").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_score, schema)
    base = F.col("log_counts") - F.col("n_tokens") * F.log10(F.lit(float(totals["n"] + totals["v"] + 1)))
    found = scored.select("_u", "n_tokens", "n_known", F.lit(totals["n"]).cast("long").alias("train_tokens"), base.alias("base_score"), "score")
    out = with_id(found, table, plain, id_col)
    return out.select(id_col, held_out(id_col, parts).alias("held_out"), *found.columns[1:])
