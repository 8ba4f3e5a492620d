"""Language identification, words first: known words score by their log frequency in each language, an unseen word by
its character n-grams, from the longest known ones down to single letters.

Training counts words (runs of letters, lower-cased) of all labelled documents per language in Spark. The classifier
keeps ``WORDS`` words and ``GRAMS`` n-grams: each language's most frequent ones, in equal shares (what a language leaves
goes to the others), so a large language does not crowd out a small one, the model has a fixed bound and is sent to the tasks. Prediction covers every whole text; a text's language, source and id play no part in it.

Cases: a null text, or one without a letter, is ``und`` with score 0; letters of which nothing is known give the
alphabetically first language with equal shares as score, as do ties; without labelled documents everything is ``und``;
other columns are ignored; repeated rows give repeated rows.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, remembered, slices, stored, strings, texts

WORDS = 100_000
GRAMS = 100_000
LONGEST_GRAM = 5
#: Words that count in full for the score; the evidence of a longer text is averaged down to so many.
SCORE_WORDS = 12
UNKNOWN = "und"
#: Length from which an n-gram, its word edges counted, is evidence that a word's letters are no chance.
EVIDENCE_GRAM = 4
CACHE = 150_000
#: Bits of a code point.
LETTER_BITS = 21


def held_out(doc_id: Column) -> Column:
    """Documents whose crc32(id as text) mod 4 is 2 are never learned from; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def train(labelled: DataFrame, words: int = WORDS, grams: int = GRAMS) -> "WordFirst":
    """Fit on (doc_id, text, lang) rows."""
    counted = labelled.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))).alias("key"))
    counted = stored(counted.groupBy("lang", "key").agg(F.count("*").alias("n")), "words")
    size = F.explode(F.sequence(F.lit(1), F.lit(LONGEST_GRAM)))
    edged = counted.select("lang", "n", F.concat(F.lit(" "), "key", F.lit(" ")).alias("w"), size.alias("k"))
    cut = F.transform(F.sequence(F.lit(1), F.length("w") - F.col("k") + 1), lambda i: F.substring("w", i, F.col("k")))
    parts = edged.where(F.length("w") >= F.col("k")).select("lang", "n", F.explode(cut).alias("key"))
    parts = parts.groupBy("lang", "key").agg(F.sum("n").alias("n"))
    parts = stored(parts, "grams")
    totals = {r["lang"]: r["n"] for r in counted.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(totals)
    return WordFirst(totals, _kept(counted.where(F.length("key") > 0), words, languages), _kept(parts, grams, languages))


def _cutoffs(sizes: dict[str, dict[int, int]], most: int) -> dict[str, tuple[int, float]]:
    """Per language the least count whose keys are all kept, and the share kept of the keys that have one count less.

    ``sizes`` has the number of keys by count. All languages get equal shares of ``most``, smaller ones all they have.
    """
    have, left, share = {x: sum(n.values()) for x, n in sizes.items()}, most, {}
    for i, x in enumerate(sorted(have, key=lambda x: (have[x], x))):
        share[x] = min(have[x], left // (len(have) - i))
        left -= share[x]
    out = {}
    for x, by_count in sizes.items():
        room, least, part = share[x], max(by_count) + 1, 0.0
        for count in sorted(by_count, reverse=True):
            if by_count[count] > room:
                least, part = count + 1, room / by_count[count]
                break
            room, least = room - by_count[count], count
        out[x] = (least, part)
    return out


def _kept(table: DataFrame, most: int, languages: list[str]) -> tuple[list[str], np.ndarray]:
    """The chosen keys in order, and their counts by language. The driver sees key counts by count, then about ``most`` rows."""
    sizes: dict[str, dict[int, int]] = {}
    for r in table.groupBy("lang", "n").agg(F.count("*").alias("keys")).toLocalIterator():
        sizes.setdefault(r["lang"], {})[r["n"]] = r["keys"]
    if not sizes:
        return [], np.zeros((0, len(languages)))
    cutoffs = [(x, least, int(part * 1_000_000)) for x, (least, part) in _cutoffs(sizes, most).items()]
    cut = F.broadcast(table.sparkSession.createDataFrame(cutoffs, "lang string, least long, part long"))
    some = (F.col("n") == F.col("least") - 1) & (F.pmod(F.xxhash64("key"), F.lit(1_000_000)) < F.col("part"))
    chosen = table.join(cut, "lang").where((F.col("n") >= F.col("least")) | some).select("key").distinct()
    by_lang = [F.coalesce(F.sum(F.when(F.col("lang") == x, F.col("n"))), F.lit(0)).alias(f"n{i}") for i, x in enumerate(languages)]
    rows = table.join(chosen, "key").groupBy("key").agg(*by_lang).toArrow().sort_by("key")
    return rows.column("key").to_pylist(), np.stack([rows.column(f"n{i}").to_numpy() for i in range(len(languages))], 1).astype(float)


class WordFirst:
    """Log frequencies per language of known words and n-grams; scores words of either kind."""

    def __init__(self, totals: dict[str, int], words: tuple[list[str], np.ndarray], grams: tuple[list[str], np.ndarray]) -> None:
        self.languages = sorted(totals)
        self.logs = np.zeros((0, len(totals)), np.float32)
        self.words = self._logs(*words, np.array([totals[x] for x in self.languages], float))
        self.grams = {}
        sizes = np.array([len(g) for g in grams[0]], int)
        for k in np.unique(sizes):
            at = np.flatnonzero(sizes == k)
            self.grams |= self._logs([grams[0][i] for i in at], grams[1][at], grams[1][at].sum(0))
        self.levels = _levels(self.grams)

    def _logs(self, keys: list[str], counts: np.ndarray, total: np.ndarray) -> dict[str, int]:
        """Places of the keys' rows in ``logs``."""
        logs = np.log((counts + 0.1) / (total + 0.1 * max(1, len(keys))))
        first = len(self.logs)
        self.logs = np.concatenate([self.logs, (logs - logs.mean(1, keepdims=True)).astype(np.float32)])
        return dict(zip(keys, range(first, first + len(keys))))

    def evidence(self, words: list[str]) -> np.ndarray:
        """A row per word: its evidence for each language, whose mean is 0, and 1 if its letters are no chance.

        A known word has its own evidence. Any other has the mean of the longest known n-grams from each of its places, and
        its letters are no chance if known n-grams of ``EVIDENCE_GRAM`` or more cover over half of them.
        """
        at = list(map(self.words.get, words))
        out = np.zeros((len(words), len(self.languages) + 1), np.float32)
        known = np.array([i is not None for i in at], bool)
        out[known, :-1], out[known, -1] = self.logs[[i for i in at if i is not None]], 1
        unseen = np.flatnonzero(~known)
        if not len(unseen):
            return out
        edged = [f" {words[i]} " for i in unseen]
        letters = np.frombuffer("".join(edged).encode("utf-32-le"), "<u4").astype(np.int64)
        sizes = np.array(list(map(len, edged)), np.int64)
        ends = np.cumsum(sizes)
        of = np.repeat(np.arange(len(unseen)), sizes)
        found, length = self._longest(letters, ends[of])
        change = np.zeros(len(letters) + 1, np.int64)
        some = np.flatnonzero(length >= EVIDENCE_GRAM)  # none reaches beyond its word
        change[some] += 1
        np.subtract.at(change, some + length[some], 1)
        covered = np.cumsum(change[:-1]) > 0
        covered[ends - 1] = covered[ends - sizes] = False
        out[unseen, -1] = 2 * np.add.reduceat(covered, ends - sizes, dtype=np.int64) > sizes - 2
        hit = np.flatnonzero(found >= 0)
        seen, logs = np.bincount(of[hit], minlength=len(unseen)), self.logs[found[hit]]
        for j in range(len(self.languages)):
            total = np.zeros(len(unseen), np.float32)
            np.add.at(total, of[hit], logs[:, j])
            out[unseen, j] = total / np.maximum(seen, 1).astype(np.float32)
        return out

    def _longest(self, letters: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The row in ``logs`` (or -1) and length of the longest known n-gram from every place that ends by its word's end."""
        found, length = np.full(len(letters), -1), np.zeros(len(letters), np.int64)
        at, node = np.arange(len(letters)), np.zeros(len(letters), np.int64)
        for k, (keys, rows) in enumerate(self.levels, 1):
            inside = at + k <= ends[at]
            at, node = at[inside], node[inside]
            key = (node << LETTER_BITS) | letters[at + k - 1]
            node = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            there = keys[node] == key
            at, node = at[there], node[there]
            named = rows[node] >= 0
            found[at[named]], length[at[named]] = rows[node[named]], k
        return found, length


def _levels(grams: dict[str, int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """A trie of the n-grams: for each length the sorted keys (number of the node one letter less, letter) and their rows, -1 for mere beginnings."""
    out, node = [], {"": 0}
    for k in range(1, max(map(len, grams), default=0) + 1):
        parts = list({g[:k] for g in grams if len(g) >= k})
        keys = np.array([(node[g[:-1]] << LETTER_BITS) | ord(g[-1]) for g in parts], np.int64)
        order = np.argsort(keys)
        node = {parts[i]: n for n, i in enumerate(order.tolist())}
        out.append((keys[order], np.array([grams.get(parts[i], -1) for i in order], np.int64)))
    return out


class _Scorer:
    """Scores whole Arrow columns; every distinct word of a task is scored once and remembered."""

    def __init__(self, model: WordFirst) -> None:
        self.model = model
        self._clear()

    def _clear(self) -> None:
        self.place: dict[str, int] = {}
        self.rows = np.zeros((0, len(self.model.languages) + 1), np.float32)

    def _evidence(self, words: list[str]) -> np.ndarray:
        """The model's rows of the words, of which it is asked only those that are not remembered."""
        if len(self.place) > CACHE:
            self._clear()
        new = [w for w in words if w not in self.place]
        self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
        self.rows = np.concatenate([self.rows, self.model.evidence(new)])
        return self.rows[[self.place[w] for w in words]]

    def __call__(self, column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and share of known words of every text."""
        lists = pc.ascii_split_whitespace(pc.replace_substring_regex(pc.utf8_lower(column), r"[^\pL]+", " "))
        # a leading or trailing separator leaves an empty part; parts of length 0 are no words
        bounds = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        words = strings(coded.dictionary)
        indices = coded.indices.to_numpy(zero_copy_only=False)
        rows = self._evidence(words)
        real = np.array([bool(w) for w in words], bool)
        rows[~real] = 0
        real = real[indices]
        doc = np.repeat(np.arange(len(column)), np.diff(bounds))
        n = np.bincount(doc, weights=real, minlength=len(column))
        total = np.stack([np.bincount(doc, weights=rows[indices, j], minlength=len(column)) for j in range(rows.shape[1])], 1)
        total, known = total[:, :-1], total[:, -1] / np.maximum(n, 1)
        scaled = total * (np.minimum(n, SCORE_WORDS) / np.maximum(n, 1))[:, None]
        share = np.exp(scaled - scaled.max(1, keepdims=True))
        share /= share.sum(1, keepdims=True)
        best = np.argmax(np.round(scaled, 9), axis=1)
        found = n > 0
        names = [self.model.languages[b] if f else UNKNOWN for b, f in zip(best, found)]
        return names, np.where(found, share[np.arange(len(best)), best], 0.0), known


def predict(docs: DataFrame, model: WordFirst, keep: tuple[str, ...], text: str = "text") -> DataFrame:
    """The columns ``keep`` of every row with lang_pred, score and known (share of the text's words that are)."""
    fields = [docs.schema[c] for c in keep]
    schema = type(docs.schema)(fields).add("lang_pred", "string").add("score", "double").add("known", "double")

    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by WORDS and GRAMS
    key, languages = uuid.uuid4().hex, bool(model.languages)

    def scored(batches):
        held = remembered("language")  # the scorer of the model last used
        if key not in held:
            held.clear()
            held[key] = _Scorer(sent.value)
        scorer = held[key]
        for batch in batches:
            column = texts(batch.column(batch.schema.get_field_index(text)))
            names, scores, shares = [], [], []
            for a, b in slices(column):
                if languages:
                    got, score, known = scorer(column[a:b])
                else:
                    got, score, known = [UNKNOWN] * (b - a), np.zeros(b - a), np.zeros(b - a)
                names += got
                scores.append(score)
                shares.append(known)
                pa.default_memory_pool().release_unused()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(names, pa.string()), *[pa.array(np.concatenate(x) if x else [], pa.float64()) for x in (scores, shares)]],
                [*keep, "lang_pred", "score", "known"])
            del batch, column  # before the next batch is read
        scorer._clear()  # an idle worker should not keep them

    # a text that is kept is sent once
    return map_arrow(docs.select(*keep, *([] if text in keep else [text])), scored, schema)


def labelled(docs: DataFrame) -> DataFrame:
    """What may be learned from: documents with a text and a language that are not held out."""
    return docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "text", "lang")


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document, learned from those that are not held out."""
    model = train(labelled(docs))
    return predict(docs.withColumn("held_out", held_out(F.col("doc_id"))), model, ("doc_id", "held_out")).drop("known")
