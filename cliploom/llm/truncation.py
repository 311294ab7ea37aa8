"""Text values that were cut off: at a length limit of their source, or in mid-transfer.

Two kinds of evidence are combined.

*Lengths.* For each source the hazard of a length L is the share of values of at least L units (characters, or UTF-8
bytes) that end at L without a final stop. A limit shows as a hazard far above its neighbours'. Each hazard is tested
against the pooled hazard of the lengths around it by a Chernoff bound of the Poisson tail, and significant lengths are
chosen with Benjamini-Hochberg control of the false-discovery rate within each source.

*Endings.* What is put after a text (tags, quotes, closing wrappers, emoji, an ellipsis) is set aside. An ending without
a final stop is then compared with the whole corpus: how often do its last words, after the same first word of the
sentence, end a sentence there? Counts come from all texts. An ending that never ends a sentence, a last word that only
occurs as the beginning of other words, a dangling comma, or a connective that isn't known to end sentences mark a cut.

At a significant length every incomplete ending is flagged, that is one without stop and without a whole tag after it;
at other lengths, which a transfer that broke off hits at random, the ending's own evidence has to show the cut. Of two
fields of a record with the same text both are flagged if one is. ``evidence`` says which of them decided.

Texts are divided and coded by Arrow kernels in whole batches. Only contexts that some ending asks for are counted: a
bit map of fixed size, made of the asked contexts' hashes, lets each task drop the others before the shuffle.

Cases: null, empty and blank values are no cases and have no row; identical records count once; very long texts are
read whole; a text of marks alone is complete; an empty table yields no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cliploom.operators.skew import join_unique
from cliploom.session import write_table

#: Neighbouring lengths on each side, the false-discovery rate, the least events and least ratio to the neighbours of a
#: significant length, and the ratio that is enough just below one (where a blank at the cut was trimmed).
NEIGHBOURS, FDR, LEAST_EVENTS, LEAST_RATIO, BESIDE_RATIO = 12, 0.001, 5, 8.0, 2.5
#: A context needs so many occurrences to decide; below these shares of sentence ends the ending is a cut.
LEAST_SEEN, SHARE_WITH_HEAD, SHARE_WITHOUT = 5, 0.2, 0.04
#: Sources that each repeat a text without stop, and their share of all sources, from which on it may be a label.
LABEL_SOURCES, LABEL_SHARE = 3, 0.5
#: Words that end no sentence, in the languages of the texts.
DANGLING = frozenset(
    "a an the and or but nor of to in on at by for from with into onto over under between behind beside near along "
    "because while as if than that which who whose its their his her our your my this these those is are was were be "
    "un una el la los las y o pero de del en con por para sin sobre entre que su sus mientras porque "
    "ein eine einen einem einer der die das den dem des und oder aber von zu im am auf mit ohne neben hinter unter "
    "weil dass sein ihre".split()
)
STOPS = ".!?。！？"
#: Characters at a text's end in which something put after it is looked for; each such thing is shorter.
REACH = 64

CONTEXTS = ("head2", "head1", "last3", "last2", "last1", "prefix")
ENDING = T.StructType([
    T.StructField("ended", T.BooleanType()),  # a final stop, tags and wrappers aside
    T.StructField("tagged", T.BooleanType()),  # something whole follows the text
    T.StructField("broken", T.BooleanType()),  # dangling mark, half a character or half a tag
    T.StructField("dangling", T.BooleanType()),
    T.StructField("contexts", T.ArrayType(T.LongType())),
    T.StructField("size", T.IntegerType()),  # letters of the last word
])
#: Bits of the map of asked contexts (2 MB); beyond about as many contexts it lets more others through, never fewer asked ones.
MAP_BITS = 1 << 24
_BREAKS = frozenset(STOPS)


class Reader:
    """Tokens and endings of texts; one per Python worker."""

    def __init__(self):
        import regex

        self.after = regex.compile(
            r"(?:\s+\#[\w-]+|\s*\[[^\[\]]{1,40}\]|\s*\([^()]{1,40}\)|\s+@\s?\d+\s?\w{2,5}|\s+\d{3,4}[pi]|\s+[-–—]\s?\p{L}+\s\d+"
            r"|\s*[\p{So}\p{Sk}‍️\U0001F3FB-\U0001F3FF--�]+|\s+“[^“”]{1,40}”|\s+(?:etc|usw)\.)$",
            regex.V1,
        )
        self.open = regex.compile(r"(?:\s[(\[][^()\[\]]{0,40}|\s[@#][\w ]{0,8}|\s[-–—]\s?\p{L}{0,12})$")
        self.close = regex.compile(r"[\s\"”»」』}`]+$")
        self.marks = regex.compile(r"[#\[(@–—“-]|\d[pi]$")
        self.ellipsis = regex.compile(r"(?:\.{2,}|…+)$")
        self.hashes: dict[str, int] = {}

    def hash(self, word: str) -> int:
        h = self.hashes.get(word)
        if h is None:
            import xxhash

            h = xxhash.xxh64_intdigest(word)
            if len(self.hashes) < 1_000_000:
                self.hashes[word] = h
        return h

    def core(self, text: str) -> tuple[str, bool, bool]:
        """(text without what was put after it, something whole was, an ellipsis was)."""
        t, tagged, cut = text.rstrip(), False, False
        if t and t[-1].isalnum() and not self.marks.search(t, max(0, len(t) - REACH)):
            return t, False, False  # nothing was put after it
        while t:
            if m := self.after.search(t, max(0, len(t) - REACH)):  # before closing marks, as a tag may be quoted itself
                u, tagged = t[: m.start()].rstrip(), True
            else:
                u = self.close.sub("", t)
                tagged |= len(u) < len(t)
            if m := self.ellipsis.search(u):
                u, cut = u[: m.start()].rstrip(), True
            if u == t:
                break
            t = u
        return t, tagged, cut

    def cores(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """:meth:`core` of each text; texts that plainly have nothing after them are not looked at one by one."""
        t = pc.utf8_rtrim_whitespace(texts)
        tail = pc.utf8_slice_codeunits(t, -REACH, None)
        stop = pc.and_(pc.match_substring_regex(tail, r"[\pL\pN][.!?。！？]$"), pc.invert(pc.match_substring_regex(tail, r"(?:etc|usw)\.$")))
        bare = pc.and_(pc.match_substring_regex(tail, r"[\pL\pN]$"), pc.invert(pc.match_substring_regex(tail, r"[#\[(@–—“-]|\d[pi]$")))
        slow = np.flatnonzero(~np.asarray(pc.or_(stop, bare)))
        tagged, cut = np.zeros(len(t), dtype=bool), np.zeros(len(t), dtype=bool)
        if len(slow):
            got = [self.core(x) for x in t.take(pa.array(slow)).to_pylist()]
            tagged[slow], cut[slow] = [g[1] for g in got], [g[2] for g in got]
            mask = np.zeros(len(t), dtype=bool)
            mask[slow] = True
            t = pc.replace_with_mask(t, pa.array(mask), pa.array([g[0] for g in got], t.type))
        return t, tagged, cut

    def tokens(self, cores: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """(number of each token's word, its text, the words): words in lower case, stops and ideographs one by one.

        A line end is a stop. Apostrophes and hyphens belong to a word only inside it.
        """
        x = pc.replace_substring(pc.utf8_lower(cores), "\n", "。")
        x = pc.replace_substring_regex(x, r"([\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}.!?。！？])", r" \1 ")
        x = pc.replace_substring_regex(x, r"[^\pL\pN\pM\s.!?。！？'’-]", " ")
        lists = pc.utf8_split_whitespace(x)
        coded = lists.flatten().dictionary_encode()
        owner = np.repeat(np.arange(len(cores)), np.asarray(lists.value_lengths()))
        plain = [w.strip("'’-") for w in coded.dictionary.to_pylist()]
        number = {w: i for i, w in enumerate(dict.fromkeys(w for w in plain if w))}
        at = np.array([number.get(w, -1) for w in plain], dtype=np.int64)[np.asarray(coded.indices)]
        return at[at >= 0], owner[at >= 0], list(number)

    def positions(self, cores: pa.Array) -> dict:
        """Of each token: word, text, whether it is a stop or its text's last, first token of its sentence; the words."""
        w, owner, words = self.tokens(cores)
        stop = np.array([x in _BREAKS for x in words], dtype=bool)[w]
        at = np.arange(len(w))
        final = np.r_[owner[1:] != owner[:-1], True] if len(w) else np.zeros(0, dtype=bool)
        new = np.r_[True, final[:-1] | stop[:-1]] if len(w) else final
        return {"w": w, "owner": owner, "words": words, "stop": stop, "final": final, "begin": np.maximum.accumulate(np.where(new, at, 0)) if len(w) else at}

    def keys(self, p: dict, some: np.ndarray) -> list[np.ndarray]:
        """The five context keys of the tokens at the places ``some``."""
        table = np.array([self.hash(x) for x in p["words"]], dtype=np.uint64)
        code = table[p["w"]] if len(p["w"]) else np.empty(0, dtype=np.uint64)
        place = some - p["begin"][some]
        c, b, a = code[some], code[np.maximum(some - 1, 0)], code[np.maximum(some - 2, 0)]
        b, a, head = np.where(place >= 1, b, np.uint64(0)), np.where(place >= 2, a, np.uint64(0)), code[p["begin"][some]]
        with np.errstate(over="ignore"):
            return [_mix_arrays(1, head, b, c), _mix_arrays(2, head, c), _mix_arrays(3, a, b, c), _mix_arrays(4, b, c), _mix_arrays(5, c)]

    def ending(self, text: str) -> tuple:
        """The fields of :data:`ENDING` of one text."""
        return tuple(self.endings(pa.array([text]))[0].as_py().values())

    def endings(self, texts: pa.Array) -> pa.StructArray:
        """:data:`ENDING` of each text."""
        cores, tagged, cut = self.cores(texts.fill_null(""))
        last = pc.utf8_slice_codeunits(cores, -1, None)
        empty = np.asarray(pc.equal(pc.utf8_length(cores), 0))
        ended = empty | (np.asarray(pc.is_in(last, pa.array(list(STOPS)))) & ~cut)
        n = len(texts)
        broken, dangling, contexts, size = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool), [[]] * n, np.zeros(n, dtype=np.int32)
        open_ = np.flatnonzero(~ended)
        if len(open_):
            some = cores.take(pa.array(open_))
            ends = some.to_pylist()
            mark = np.array([x[-1] in ",，、;；:：-–—'’�" or bool(self.open.search(x, max(0, len(x) - REACH))) for x in ends])
            p = self.positions(some)
            at = np.flatnonzero(p["final"] & ~p["stop"])
            who = p["owner"][at]
            bare = np.ones(len(open_), dtype=bool)  # no word after the last stop
            bare[who] = False
            broken[open_] = np.where(bare, mark & ~tagged[open_], mark)
            ended[open_[bare]] = ~cut[open_[bare]]
            rows = np.stack([*(k.view(np.int64) for k in self.keys(p, at)), np.array([signed(self.hash("^" + p["words"][i])) for i in p["w"][at]], dtype=np.int64)], axis=1) if len(at) else []
            for i, o in enumerate(open_[who]):
                word = p["words"][p["w"][at[i]]]
                contexts[o], dangling[o], size[o] = rows[i].tolist(), word in DANGLING, len(word)
        return pa.StructArray.from_arrays([pa.array(ended), pa.array(tagged), pa.array(broken), pa.array(dangling), pa.array(contexts, pa.list_(pa.int64())), pa.array(size)], [f.name for f in ENDING])


def signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def _mix_arrays(kind: int, *parts: np.ndarray) -> np.ndarray:
    """Key of a context from its kind and its tokens' hashes; a context longer than the sentence repeats the empty token."""
    h = np.full(len(parts[0]), kind * 0x9E3779B97F4A7C15 & (1 << 64) - 1, dtype=np.uint64)
    for p in parts:
        h = (h ^ p) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    return h


_reader: list[Reader] = []


def reader() -> Reader:
    if not _reader:
        _reader.append(Reader())
    return _reader[0]


@F.arrow_udf(ENDING)
def ending(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield reader().endings(batch)


def asked_map(asked: DataFrame) -> np.ndarray:
    """Bit map of the hashes of the asked contexts: MAP_BITS bits, whatever their number."""
    bit = F.pmod(F.col("context"), F.lit(MAP_BITS))
    words = asked.groupBy(F.shiftright(bit, 6).alias("i")).agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(pmod(context, {MAP_BITS}) % 64 AS INT))")).alias("bits")).toArrow()
    out = np.zeros(MAP_BITS // 64, dtype=np.int64)
    out[words.column("i").to_numpy()] = words.column("bits").to_numpy()
    return out


def _count_contexts(shared, sizes: list[int]):
    """mapInArrow function: (context, seen, ends) partial counts of asked contexts in a task's texts."""

    def asked(keys: np.ndarray) -> np.ndarray:
        bit = keys.view(np.int64) % MAP_BITS
        return (shared.value[bit >> 6] >> (bit & 63)) & 1 == 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = reader()
        for batch in batches:
            p = r.positions(r.cores(batch.column(0).fill_null(""))[0])
            some = np.flatnonzero(~p["stop"] & ~p["final"])  # the end of a text without a stop says nothing
            if not len(some):
                continue
            ended = p["stop"][some + 1]
            keys, ends = np.concatenate(r.keys(p, some)), np.tile(ended, 5).astype(np.int64)
            # Beginnings of words, of the lengths that are asked for, counted by the words that go on.
            n = np.bincount(p["w"][some], minlength=len(p["words"]))
            first = [("^" + x[:k], int(m)) for x, m in zip(p["words"], n) if m for k in sizes if k < len(x)]
            keys = np.concatenate([keys, np.array([r.hash(x) for x, _ in first], dtype=np.uint64)])
            seen = np.concatenate([np.ones(len(ends), dtype=np.int64), np.array([m for _, m in first], dtype=np.int64)])
            ends = np.concatenate([ends, np.zeros(len(first), dtype=np.int64)])
            wanted = asked(keys)
            key, inverse = np.unique(keys[wanted], return_inverse=True)
            counts = [np.bincount(inverse, x[wanted], len(key)).astype(np.int64) for x in (seen, ends)]
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), *(pa.array(c) for c in counts)], ["context", "seen", "ends"])

    return run


def context_counts(texts: DataFrame, asked: DataFrame, sizes: list[int]) -> DataFrame:
    """(context, seen, ends) over all texts of the column ``text``, of all contexts in ``asked`` and a few others.

    ``sizes``: lengths of the last words whose beginnings are asked for.
    """
    shared = texts.sparkSession.sparkContext.broadcast(asked_map(asked))
    parts = texts.select("text").mapInArrow(_count_contexts(shared, sizes), "context bigint, seen bigint, ends bigint")
    return parts.groupBy("context").agg(F.sum("seen").alias("seen"), F.sum("ends").alias("ends"))


def significant_lengths(values: DataFrame, unit: str) -> DataFrame:
    """(source, script, unit, length, events, at_risk, expected, p, significant) of judged values, lengths from column ``unit``.

    Each text of a source counts once: a label that many records share is no limit.
    """
    once = values.select("source", "script", "same", F.col(unit).alias("length"), (F.col("open") & ~F.col("tagged")).alias("open")).distinct()
    bars = once.groupBy("source", "script", "length").agg(F.count_if("open").alias("events"), F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("source", "script")
    bars = bars.withColumn("at_risk", F.sum("n").over(w.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)))
    near = w.orderBy("length").rangeBetween(-NEIGHBOURS, NEIGHBOURS)
    other_events = F.sum("events").over(near) - F.col("events")
    other_risk = F.sum("at_risk").over(near) - F.col("at_risk")
    bars = bars.withColumn("expected", F.col("at_risk") * (other_events + 0.5) / (other_risk + 1.0))
    k, lam = F.col("events").cast("double"), F.col("expected")
    bound = F.when(k > lam, F.exp(-(k * F.log(k / lam) - k + lam))).otherwise(F.lit(1.0))
    tested = bars.withColumn("p", F.when(F.col("events") > 0, bound).otherwise(F.lit(1.0)))
    rank = F.row_number().over(w.orderBy("p", "length"))
    passed = F.when(F.col("p") <= FDR * rank / F.count(F.lit(1)).over(w), F.col("p"))
    limit = F.max(passed).over(w)
    found = tested.withColumn("far", F.coalesce((F.col("p") <= limit) & (F.col("events") >= LEAST_EVENTS), F.lit(False)))
    found = found.withColumn("strong", F.col("far") & (k >= LEAST_RATIO * lam))
    up = w.orderBy("length")
    beside = F.lead("strong", 1, False).over(up) & (F.lead("length").over(up) == F.col("length") + 1) & (k >= BESIDE_RATIO * lam)
    found = found.withColumn("significant", F.col("strong") | (F.col("far") & F.coalesce(beside, F.lit(False))))
    return found.select("source", "script", F.lit(unit).alias("unit"), "length", "events", "at_risk", "expected", "p", "significant")


def _at_limit(values: DataFrame, lengths: DataFrame, unit: str) -> DataFrame:
    """``values`` with ``at_<unit>``: whether the length is a significant one of the source.

    A byte limit inside a character leaves up to three bytes unused. A source has few significant lengths.
    """
    reach = F.expr("sequence(length - 3, length)") if unit == "bytes" else F.array("length")
    limits = lengths.where("significant").groupBy("source", "script").agg(F.array_distinct(F.flatten(F.collect_list(reach))).alias("__at"))
    joined = values.join(F.broadcast(limits) if limits.count() <= 10_000 else limits, ["source", "script"], "left")
    return joined.withColumn(f"at_{unit}", F.coalesce(F.array_contains("__at", F.col(unit)), F.lit(False))).drop("__at")


def _ending_verdict() -> Column:
    """True for a cut, by the most telling context that occurs often enough; null if none does."""
    at = lambda i, f: F.coalesce(F.col(f"f{i}.{f}"), F.lit(0))
    verdict = F.lit(None).cast("boolean")
    for i in reversed(range(5)):
        share = SHARE_WITH_HEAD if i < 2 else SHARE_WITHOUT
        need = LEAST_SEEN if i in (0, 2, 3) else 2 * LEAST_SEEN
        verdict = F.when(at(i, "seen") >= need, at(i, "ends") < share * at(i, "seen")).otherwise(verdict)
    begins = (at(5, "seen") >= LEAST_SEEN) & (at(4, "seen") * 10 < at(5, "seen"))
    return F.when(begins & (at(4, "seen") < 2 * LEAST_SEEN), F.lit(True)).otherwise(verdict)


def _label() -> Column:
    """True for a text that sources repeat alike and whose last word, a whole one, isn't known after the word before it."""
    seen = lambda i: F.coalesce(F.col(f"f{i}.seen"), F.lit(0))
    unknown = (seen(0) == 0) & (seen(2) < LEAST_SEEN) & (seen(3) < LEAST_SEEN)
    return F.col("one") & unknown & (seen(4) >= LEAST_SEEN)


def endings(values: DataFrame) -> DataFrame:
    """``values`` (with ``text``) plus ``open`` (no final stop), ``tagged`` and ``cut_by_ending``; reads ``values`` twice."""
    read = values.withColumn("e", ending("text"))
    fields = [F.col(f"e.{f.name}").alias(f.name) for f in ENDING]
    read = write_table(read.select(*[c for c in values.columns if c != "text"], *fields), "endings")
    # A cut of one source doesn't end at the same place in most of the others, nor does one source hold most copies of a label.
    least = max(LABEL_SOURCES, LABEL_SHARE * read.select("source").distinct().count())
    unclear = read.where(~F.col("ended") & (F.size("contexts") > 0)).groupBy("contexts", "source").agg(F.count(F.lit(1)).alias("n"), F.min("same").alias("low"), F.max("same").alias("high"))
    spread = (F.count_if(F.col("n") > 1) >= least) & (2 * F.max("n") <= F.sum("n"))
    unclear = unclear.groupBy("contexts").agg((spread & (F.min("low") == F.max("high"))).alias("one")).withColumn("tail", F.xxhash64("contexts"))
    asked = write_table(unclear.select("tail", "one", F.posexplode("contexts").alias("i", "context")), "asked")
    sizes = sorted(r["size"] for r in read.where("size > 0").select("size").distinct().collect())  # lengths of words
    counts = write_table(context_counts(values, asked, sizes), "context-counts")
    known = join_unique(asked, counts, "context")
    facts = known.groupBy("tail", "one").agg(*[F.max(F.when(F.col("i") == i, F.struct("seen", "ends"))).alias(f"f{i}") for i in range(len(CONTEXTS))])
    facts = write_table(facts.select("tail", _ending_verdict().alias("verdict"), _label().alias("label")), "ending-facts")
    keyed = read.withColumn("tail", F.when(~F.col("ended") & (F.size("contexts") > 0), F.xxhash64("contexts")))
    joined = join_unique(keyed, facts, "tail").drop("tail", "contexts", "size")
    label = F.coalesce("label", F.lit(False)) & ~F.col("dangling")
    # A connective that the corpus knows to end sentences ("passes behind") is no sign of a cut.
    cut = ~F.col("ended") & (F.col("broken") | (~label & F.coalesce("verdict", F.col("dangling"))))
    return joined.withColumn("cut_by_ending", cut).withColumn("open", ~F.col("ended"))


def find_truncated(values: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(one row per value with ``cut`` and ``evidence``, the table of lengths).

    ``values``: (id, field, source, text), one row per value, a written table, as it is read twice; other columns are
    left out.
    """
    values = values.select("id", "field", "source", "text")
    sized = values.where("text is not null and trim(text) <> ''").withColumn("chars", F.length("text")).withColumn("bytes", F.octet_length("text")).withColumn("same", F.xxhash64("text"))
    # Limits in bytes lie at other lengths where characters are wide, so scripts are tested apart.
    sized = sized.withColumn("source", F.coalesce("source", F.lit(""))).withColumn("script", F.when(F.col("bytes") > 1.5 * F.col("chars"), "wide").otherwise("narrow"))
    judged = write_table(endings(sized), "judged")
    # Bytes are tested on values where they differ from characters, and whose characters are at no limit already.
    in_chars = write_table(significant_lengths(judged, "chars"), "lengths")
    marked = _at_limit(judged, in_chars, "chars")
    wide = F.col("bytes") > F.col("chars")
    in_bytes = write_table(significant_lengths(marked.where(wide & ~F.col("at_chars")), "bytes"), "lengths")
    flagged = _at_limit(marked, in_bytes, "bytes").withColumn("at_limit", F.col("at_chars") | (F.col("at_bytes") & wide))
    # A whole tag after the text shows that the text itself was not at the end of the field.
    flagged = flagged.withColumn("own", F.col("cut_by_ending") | (F.col("at_limit") & F.col("open") & ~F.col("tagged")))
    # The length decides where it is significant; else the ending; else the other field's equal text.
    decided = F.when(F.col("at_limit") & F.col("open") & ~F.col("tagged"), 0).when(F.col("cut_by_ending"), 1)
    flagged = flagged.withColumn("decided", decided)
    shared = flagged.groupBy("id", "same").agg(F.bool_or("own").alias("cut"), F.min("decided").alias("d"), F.collect_list(F.struct("field", "source", "chars", "bytes", "at_limit")).alias("l"))
    evidence = F.when(F.col("d") == 0, "length").when(F.col("d") == 1, "ending")
    return shared.select("id", "cut", evidence.alias("evidence"), F.inline("l")), in_chars.unionByName(in_bytes)
