"""Extraction post-processing: taxonomy linking, relation assembly, lexicon matching, triple mining."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilframe.functions.fold import let, scan
from veilframe.session import materialise, small

# taxonomy ----------------------------------------------------------------------------------


def closure(edges: DataFrame) -> DataFrame:
    """(child, ancestor) pairs over (child, parent) edges of any depth; a cycle makes its members their own ancestors.

    Where every way up goes through single parents to a root, ancestors are carried down as one array a node, each node once
    and no pair twice. Other nodes (several parents above, cycles, nulls): one equi join per level on the pairs that are
    new, each level written, until a level finds nothing new.
    """
    edges = materialise(edges.select("child", "parent").distinct(), "edges")
    one = edges.groupBy("child").agg(F.min("parent").alias("parent"), F.count(F.lit(1)).alias("_n")).where(
        "_n = 1 AND child IS NOT NULL AND parent IS NOT NULL").select(F.col("child").alias("_child"), F.col("parent").alias("_parent"))
    one = materialise(one, "edges")
    level = one.join(edges, F.col("_parent") == F.col("child"), "left_anti").select(F.col("_child").alias("child"), F.array("_parent").alias("_up"))
    level = materialise(level, "closure")
    down = level
    while not level.isEmpty():
        level = materialise(level.join(one, F.col("child") == F.col("_parent")).select(
            F.col("_child").alias("child"), F.concat("_up", F.array("_parent")).alias("_up")), "closure")
        down = down.unionByName(level)
    rest = materialise(edges.join(down.select("child"), "child", "left_anti"), "edges")
    return down.select("child", F.explode("_up").alias("ancestor")).unionByName(_levels(rest, edges))


def _levels(edges: DataFrame, every: DataFrame) -> DataFrame:
    """closure() of the children of `edges`, all of whose ways up are in `every`, level by level."""
    up = every.select(F.col("child").alias("_via"), F.col("parent").alias("_up"))
    frontier = materialise(edges.select("child", F.col("parent").alias("ancestor")), "closure")
    out = frontier
    while not frontier.isEmpty():
        found = frontier.join(up, F.col("ancestor") == F.col("_via")).select("child", F.col("_up").alias("ancestor")).distinct()
        frontier = materialise(found.join(out, ["child", "ancestor"], "left_anti"), "closure")
        out = out.unionByName(frontier)
    return out


def paths(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Root-to-node path of every node, of any depth (a node with two parents has two paths).

    A path does not enter a node twice, so cycles end; nodes that no root leads to have no path.
    """
    top = nodes.join(edges, nodes["id"] == edges["child"], "left_anti").select("id", F.array("id").alias("_at"))
    level = materialise(top, "paths")
    out = level
    while not level.isEmpty():
        level = materialise(level.join(edges, (level["id"] == edges["parent"]) & ~F.array_contains("_at", F.col("child"))).select(
            F.col("child").alias("id"), F.concat("_at", F.array("child")).alias("_at")), "paths")
        out = out.unionByName(level)
    return out.select("id", F.array_join(F.transform("_at", lambda x: x.cast("string")), "/").alias("path"))


def link_terms(items: DataFrame, nodes: DataFrame, reach: DataFrame) -> DataFrame:
    """Best term per item(key, item, target_type[, target_src]).

    nodes(id, term, alias array, termtype, subtype array, base, node_type), reach(id, type) says
    which types a node stands under. Best is (exact type, exact term); a term found only through an
    alias is reported but not linked (termid stays null).
    """
    names = nodes.where("node_type = 'term'").select(
        "id", "term", "termtype", "subtype", "base",
        F.explode(F.array_distinct(F.concat(F.array("term"), F.coalesce("alias", F.array().cast("array<string>"))))).alias("item"))
    # restrict by type before meeting the items, so the join key is (name, type)
    typed = names.join(reach, "id").withColumnRenamed("type", "target_type")
    hits = items.join(small(typed), ["item", "target_type"])
    if "target_src" in items.columns:
        hits = hits.where(F.col("target_src").isNull() | F.col("base").startswith(F.lower("target_src")))
    exact_type = (F.col("termtype") == F.col("target_type")) | F.array_contains("subtype", F.col("target_type"))
    rank = F.struct(exact_type, F.col("term") == F.col("item"), F.col("id"))
    best = hits.groupBy("key", "item").agg(F.max_by(F.struct("id", "term"), rank).alias("b"))
    return best.select("key", "item", F.col("b.id").alias("found"),
                       F.when(F.col("b.term") == F.col("item"), F.col("b.id")).alias("termid"))


# relations ---------------------------------------------------------------------------------

def prompt(entity: Column, node: Column, chinese: bool = True) -> Column:
    return F.concat(entity, F.lit("的"), node) if chinese else F.concat(node, F.lit(" of "), entity)


def expand_prompts(docs: DataFrame, entities: DataFrame, doc: str, node: str, chinese: bool = True) -> DataFrame:
    """Next-stage inputs: every text with every entity found at the parent."""
    out = docs.join(entities.select(doc, "entity").distinct(), doc)
    return out.withColumn("prompt", prompt(F.col("entity"), F.lit(node), chinese))


def assemble(parent: DataFrame, child: DataFrame, keys: list[str], child_cols: list[str], out: str = "relations") -> DataFrame:
    """Attach child rows to their parent (doc, text, start, ...) as a sorted array, level by level."""
    grouped = child.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*child_cols))).alias(out))
    return parent.join(grouped, keys, "left")


def decode_relations(spans: DataFrame, heads: DataFrame, tails: DataFrame, doc: str) -> DataFrame:
    """Span pairs supported by a positive head and tail score of one predicate; probability = product.

    spans(doc, start, end), heads(doc, predicate, s, o, score, prob) on starts, tails on ends. Works
    outwards from the scores, so span pairs without support never arise.
    """
    subj = spans.select(doc, F.col("start").alias("s"), F.col("end").alias("s_end"))
    obj = spans.select(doc, F.col("start").alias("o"), F.col("end").alias("o_end"))
    h = heads.where("score > 0").select(doc, "predicate", "s", "o", F.col("prob").alias("p_head"))
    t = tails.where("score > 0").select(doc, "predicate", F.col("s").alias("s_end"), F.col("o").alias("o_end"), F.col("prob").alias("p_tail"))
    return (h.join(subj, [doc, "s"]).join(obj, [doc, "o"]).join(t, [doc, "predicate", "s_end", "o_end"])
            .withColumn("probability", F.col("p_head") * F.col("p_tail")))


def with_entities(relations: DataFrame, entities: DataFrame) -> DataFrame:
    """relations(doc, from_id, to_id, type) with subject and object of entities(id, ...)."""
    side = lambda p, key: entities.select(F.col("id").alias(key), *[F.col(c).alias(f"{p}_{c}") for c in entities.columns if c != "id"])
    return relations.join(side("subject", "from_id"), "from_id").join(side("object", "to_id"), "to_id")


def relation_groups(prompts: DataFrame, chinese: bool = True) -> DataFrame:
    """Relation type of a prompt: text behind the last 的, or before the first ' of '."""
    p = F.col("prompt")
    kind = F.substring_index(p, "的", -1) if chinese else F.substring_index(p, " of ", 1)
    return prompts.where(p.contains("的" if chinese else " of ")).withColumn("relation_type", kind)


# lexicon -----------------------------------------------------------------------------------

def override_tags(tags: Column, matches: Column) -> Column:
    """Rewrite tags inside lexicon matches: struct<start, end, tags, offsets>, prefix style.

    Word k of a phrase covers up to its offset and takes tag k; words begin with B, the rest is I.
    """
    def tag(found, t, i):
        m = F.get(F.filter(found, lambda x: (x["start"] <= i) & (i < x["end"])), F.lit(0))
        rel = i - m["start"]
        word = F.size(F.filter(m["offsets"], lambda o: o <= rel))
        name = F.coalesce(F.get(m["tags"], word - 1), F.lit(""))
        head = F.when(F.array_contains(m["offsets"], rel) | (rel == 0), "B").otherwise("I")
        old = F.regexp_replace(t, "^[BIOES]", "")
        return F.when(m.isNull(), t).otherwise(F.concat(head, F.when(name == "", old).otherwise(F.concat(F.lit("-"), name))))
    return let(matches, lambda found: F.transform(tags, lambda t, i: tag(found, t, i)))


def _pieces(length, d: int):
    """How many pieces a term is cut into and where piece i begins: d + 1 of nearly one size, single characters of shorter terms."""
    k = F.greatest(F.least(length, F.lit(d + 1)), F.lit(1))
    return k, lambda i: F.floor(F.lit(i) * length / k).cast("int")


def near_terms(queries: DataFrame, terms: DataFrame, max_distance: int = 2) -> DataFrame:
    """Term pairs within edit distance 1 or 2, ordered by (distance, -common prefix).

    A term is cut into one piece more than edits are allowed, so one piece of it stays whole in every word that near; words meet at
    (length of the term, number of the piece, piece) and only where the piece has not moved further than the edits
    and the lengths let it. Words so short that all their characters may change meet at their shortness, where any two are near.
    """
    if max_distance not in (1, 2):
        raise ValueError("max_distance must be 1 or 2")
    d = max_distance

    def keyed(df, name, keys):
        rows = df.select(F.col(name)).where(F.col(name).isNotNull()).distinct()
        short = F.when(F.length(name) <= d, F.struct(F.lit(-1).alias("n"), F.lit(0).alias("i"), F.lit("").alias("piece")))
        every = F.array_distinct(F.array_compact(F.array(short, *keys(F.col(name)))))
        return rows.select(name, F.explode(every).alias("_k"))

    def entry(n, i, piece):
        return F.struct(n.cast("int").alias("n"), F.lit(i).alias("i"), piece.alias("piece"))

    def of_term(w):
        n = F.length(w)
        k, begin = _pieces(n, d)
        return [F.when(F.lit(i) < k, entry(n, i, F.substring(w, begin(i) + 1, begin(i + 1) - begin(i)))) for i in range(d + 1)]

    def of_query(w):
        out = []
        for more in range(-d, d + 1):  # how much longer the query is than the term
            n = F.length(w) - more
            k, begin = _pieces(n, d)
            for i in range(d + 1):
                for moved in range(-d, d + 1):
                    if abs(moved) + abs(more - moved) <= d:
                        at, size = begin(i) + moved, begin(i + 1) - begin(i)
                        fits = (n > 0) & (F.lit(i) < k) & (at >= 0) & (at + size <= F.length(w))
                        out.append(F.when(fits, entry(n, i, F.substring(w, at + 1, size))))
        return out

    pairs = keyed(queries, "query", of_query).join(keyed(terms, "term", of_term), "_k").select("query", "term")
    # far pairs go before the near ones are made distinct
    pairs = pairs.withColumn("distance", F.levenshtein("query", "term", d)).where("distance >= 0").distinct()
    common = F.size(F.filter(F.transform(F.sequence(F.lit(1), F.greatest(F.length("query"), F.lit(1))), lambda i: (
        F.substring(F.col("query"), F.lit(1), i) == F.substring(F.col("term"), F.lit(1), i)) & (i <= F.length("term"))), lambda x: x))
    return pairs.withColumn("common_prefix", common)


# triples -----------------------------------------------------------------------------------

STOPS = "，？、。；"  # fixed value: a triple does not reach over these
JOINERS = ["、", "和", "与", "及", "以及"]


def mine_triples(sentences: DataFrame, key: str, items: str, configs: list[dict],
                 stops=tuple(STOPS.replace("、", ""))) -> DataFrame:
    """Head - trigger - tail triples from tagged tokens (array<struct<item,tag>>).

    configs: dicts with group, head (tag), triggers (words), tails (tags), reverse. The head is the
    nearest one before the trigger, the tail the nearest one behind it or else between both, none
    across a stop. Tails joined by a conjunction belong together.
    """
    found_type = "array<struct<trigger:int,head:int,tail:int>>"
    null = F.lit(None).cast("int")

    def of_config(it, c):
        marked = F.transform(it, lambda x, i: F.struct(
            i.alias("i"), (x["tag"] == c["head"]).alias("head"), x["tag"].isin(c["tails"]).alias("tail"),
            x["item"].isin(list(stops)).alias("stop"), x["item"].isin(c["triggers"]).alias("trig")))

        def emit(acc, x, head, tail):
            one = F.array(F.struct(x["i"].alias("trigger"), head.alias("head"), tail.alias("tail")))
            return F.when(x["trig"], F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out")

        def forward(acc, x):  # nearest head, and nearest tail behind that head
            return F.struct(
                F.when(x["stop"], null).when(x["head"], x["i"]).otherwise(acc["h"]).alias("h"),
                F.when(x["stop"] | x["head"], null).when(x["tail"], x["i"]).otherwise(acc["t"]).alias("t"),
                emit(acc, x, acc["h"], acc["t"]))

        def backward(acc, x):  # nearest tail to the right
            return F.struct(F.when(x["stop"], null).when(x["tail"], x["i"]).otherwise(acc["t"]).alias("t"),
                            emit(acc, x, null, acc["t"]))

        none = F.array().cast(found_type).alias("out")
        left = scan(marked, F.struct(null.alias("h"), null.alias("t"), none), ["h", "t"], found_type, forward)
        right = scan(F.reverse(marked), F.struct(null.alias("t"), none), ["t"], found_type, backward)
        both = F.zip_with(left, F.reverse(right), lambda a, b: F.struct(
            a["trigger"].alias("trigger"), a["head"].alias("head"), F.coalesce(b["tail"], a["tail"]).alias("tail"),
            F.when(b["tail"].isNotNull(), "HGT").otherwise("HTG").alias("src")))

        def with_joined(x):
            ok = lambda k: (F.get(it, x["tail"] + 2 * k + 1)["item"].isin(JOINERS)
                            & F.get(it, x["tail"] + 2 * k + 2)["tag"].isin(c["tails"]))
            joined = F.when(F.coalesce(ok(F.lit(0)), F.lit(False)), F.array_min(F.filter(
                F.sequence(F.lit(1), F.floor((F.size(it) - x["tail"]) / 2).cast("int") + 1),
                lambda k: ~F.coalesce(ok(k), F.lit(False))))).otherwise(F.lit(0))
            return F.struct(
                F.lit(c["group"]).alias("group"), x["src"].alias("src"), x["head"].alias("head"),
                x["trigger"].alias("trigger"), F.sequence(x["tail"], x["tail"] + 2 * joined, F.lit(2)).alias("tails"),
                F.lit(bool(c.get("reverse"))).alias("reverse"))

        return F.transform(F.filter(both, lambda x: x["head"].isNotNull() & x["tail"].isNotNull()), with_joined)

    def triples(it):
        return F.concat(*[of_config(it, c) for c in configs])

    rows = sentences.select(key, items, F.explode_outer(let(F.col(items), triples)).alias("t")).where("t is not null")
    rows = rows.select(key, items, "t.*").withColumn("tail", F.explode("tails"))
    item = lambda p: F.get(F.col(items), p)["item"]
    subject = F.when(F.col("reverse"), F.col("tail")).otherwise(F.col("head"))
    obj = F.when(F.col("reverse"), F.col("head")).otherwise(F.col("tail"))
    return rows.select(key, "group", F.when(F.col("reverse"), "REVERSE").otherwise(F.col("src")).alias("src"),
                       subject.alias("head_pos"), item(subject).alias("head"), F.col("trigger").alias("trigger_pos"),
                       item(F.col("trigger")).alias("trigger"), obj.alias("tail_pos"), item(obj).alias("tail"))


# relations by configuration ----------------------------------------------------------------

# fixed values: signs and words that join items of a kind, the tag such words have, signs no tail lies behind, where support ends
JOINING_SIGNS = frozenset("、 《》/")
JOINING_WORDS = frozenset(["和", "与", "兼", "及", "以及", "还有", "并"])
JOINING_TAG = "连词"
TAIL_STOPS = frozenset("，？、。；")
SUPPORT_STOP = "，"
DATE, DATE_TAG = r"\d{4}年\d{1,2}月\d{1,2}日", "时间类_具体时间"


class Group(NamedTuple):
    """A relation of one head tag: its trigger words, tails as (tags, support tags), whether it is turned round, and its counterpart's name."""
    words: frozenset[str]
    tails: list[tuple[frozenset[str], tuple[str, ...]]]
    reverse: bool
    relative: str | None


class Machine:
    """All relations of one head tag, run over the items behind a head from left to right."""

    def __init__(self, head: str):
        self.head = head
        self.groups: dict[str, Group] = {}
        self.triggers: dict[str, tuple[str, bool]] = {}  # word -> group, whether the word is itself the tail

    def add(self, c: dict) -> None:
        old = self.groups.get(c["group"])
        words = frozenset(c["trig_word"]) | (old.words if old else frozenset())
        tails = [(frozenset(t["main"]), tuple(t.get("support") or ())) for t in c["tail_role"]]
        self.groups[c["group"]] = Group(words, tails, bool(c["reverse"]), c.get("rel_group") or (old.relative if old else None))
        self.triggers |= {w: (c["group"], c["trig_type"] == "role") for w in c["trig_word"]}


def of_kind(tag: str, wanted: frozenset[str]) -> bool:
    return tag in wanted or tag.split("_")[0] in wanted


class Tokens:
    """Items and tags of sentences laid end to end, as codes: a test is made once for each different word or tag."""

    def __init__(self, items: pa.Array, tags: pa.Array):
        (self.item, self.items), (self.tag, tags) = coded(items), coded(tags)
        self.tags = tags.to_pylist()
        dates = [i for i in places(pc.match_substring(self.items, "年")) if re.fullmatch(DATE, self.items[i].as_py())]
        if dates:
            if DATE_TAG not in self.tags:
                self.tags.append(DATE_TAG)
            self.tag[np.isin(self.item, dates)] = self.tags.index(DATE_TAG)
        self.sign, self.end = self.item_in(JOINING_SIGNS), self.item_in(TAIL_STOPS)
        self.joins = self.sign | (self.item_in(JOINING_WORDS) & self.tag_is(JOINING_TAG.__eq__))
        self.support_stops = places(self.item_in({SUPPORT_STOP}))

    def item_in(self, words) -> np.ndarray:
        return pc.is_in(self.items, pa.array([*words], pa.string())).to_numpy(zero_copy_only=False)[self.item]

    def tag_is(self, test) -> np.ndarray:
        return np.fromiter(map(test, self.tags), bool, len(self.tags))[self.tag]

    def runs(self, fits: np.ndarray) -> bytes:
        """Of every place whether a run of items that fit takes it (1), passes over it (2) or ends before it (0)."""
        return np.where(self.sign, 2, np.where(fits, 1, np.where(self.joins, 2, 0))).astype(np.uint8).tobytes()


def coded(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    codes = pc.fill_null(texts.cast(pa.string()), "").dictionary_encode()
    return np.array(codes.indices), codes.dictionary


def places(flags) -> list[int]:
    return np.flatnonzero(flags).tolist()


def together(runs: bytes, at: int, step: int, end: int) -> list[int]:
    """Places of the items from `at` on that fit and stand side by side, signs and words that join them left out."""
    out, p = [at], at + step
    while p != end and (kind := runs[p]):
        if kind == 1:
            out.append(p)
        p += step
    return out


class Step(NamedTuple):
    """What a machine finds at a trigger. right and left: (place, support tags, tails), the left one's tails as far as the sentence goes."""
    group: str
    is_tail: bool
    triggers: list[int]
    last: int
    right: tuple[int, tuple[str, ...], list[int]] | None
    left: tuple[int, tuple[str, ...], list[int]] | None
    behind: int  # the next trigger behind what is on the right
    after: int  # the next trigger


class Walk:
    """A machine over tokens. What it finds at a trigger does not depend on the head, so it is found once for all heads before it."""

    def __init__(self, machine: Machine, tokens: Tokens):
        self.machine, self.tokens, self.size = machine, tokens, len(tokens.item)
        self.triggers = [*places(tokens.item_in(machine.triggers)), self.size]
        self.steps: dict[int, Step] = {}
        self.known: dict = {}

    def once(self, key, make):
        if key not in self.known:
            self.known[key] = make()
        return self.known[key]

    def next_trigger(self, at: int) -> int:
        return self.triggers[bisect_left(self.triggers, at)]

    def tail_runs(self, name: str, n: int) -> bytes:
        main = self.machine.groups[name].tails[n][0]
        return self.once(("tails", name, n), lambda: self.tokens.runs(self.tokens.tag_is(lambda tag: of_kind(tag, main))))

    def tails_of(self, name: str) -> tuple[list[int], list[int]]:
        """Places at which a search for a tail ends, and the kind of tail there: none (-1) at a stop or another head."""
        group, t = self.machine.groups[name], self.tokens

        def kind(tag: str) -> int:
            fits = next((n for n, (main, _) in enumerate(group.tails) if of_kind(tag, main)), -2)
            return -1 if fits and group.tails and tag.startswith(self.machine.head) else fits

        kinds = np.where(t.end, -1, np.array([*map(kind, t.tags)], np.int64)[t.tag])
        at = places(kinds > -2)
        return at, kinds[at].tolist()

    def step(self, p: int, lo: int, end: int) -> Step:
        """What is found at the trigger at p of the sentence from lo to end."""
        name, is_tail = self.machine.triggers[self.tokens.items[self.tokens.item[p]].as_py()]
        group, right, left = self.machine.groups[name], None, None
        found = lambda q, n, step, stop: (q, group.tails[n][1], together(self.tail_runs(name, n), q, step, stop))
        if is_tail:
            triggers, last, tag = [], p, self.tokens.tags[self.tokens.tag[p]]
            kind = next((n for n, (main, _) in enumerate(group.tails) if of_kind(tag, main)), None)
            right = found(p, kind, 1, end) if kind is not None else None
        else:
            triggers = together(self.once(("triggers", name), lambda: self.tokens.runs(self.tokens.item_in(group.words))), p, 1, end)
            last = triggers[-1]
            at, kinds = self.once(("ends", name), lambda: self.tails_of(name))
            i = bisect_left(at, last + 1)
            if last + 2 < end and i < len(at) and at[i] < end and kinds[i] >= 0:
                right = found(at[i], kinds[i], 1, end)
            i = bisect_right(at, p) - 1
            if right is None and i >= 0 and at[i] >= lo and kinds[i] >= 0:
                left = found(at[i], kinds[i], -1, lo - 1)
        self.steps[p] = step = Step(name, is_tail, triggers, last, right, left, self.next_trigger(right[2][-1] + 1) if right else self.size, self.next_trigger(last + 1))
        return step

    def tag_again(self, h: int) -> int:
        """The next place with the tag of the head at h."""
        tag = self.tokens.tag[h]
        same = self.once(("tag", int(tag)), lambda: [*places(self.tokens.tag == tag), self.size])
        return same[bisect_right(same, h)]

    def support(self, tags: tuple[str, ...], above: int, below: int) -> list[int]:
        """Places of support between the two, from the last one to where it stops."""
        if not tags:
            return []
        stops = self.tokens.support_stops
        if i := bisect_left(stops, below):
            above = max(above, stops[i - 1])
        at = self.once(("support", tags), lambda: places(self.tokens.tag_is(lambda tag: tag.startswith(tags))))
        return at[bisect_right(at, above):bisect_left(at, below)][::-1]

    def relations(self, h: int, lo: int, end: int):
        """(group, source, tails, trigger words, support) of the head at h of the sentence from lo to end."""
        p, done = self.next_trigger(h + 1), h
        while p < end:
            name, is_tail, triggers, last, right, left, behind, after = self.steps.get(p) or self.step(p, lo, end)
            if right and not (is_tail and self.tag_again(h) <= p):
                at, kinds, tails = right
                yield name, "TAIL" if is_tail else "HGT", tails, triggers, self.support(kinds, h, at + is_tail) if kinds else []
                done, p = tails[-1], behind
                continue
            if left and left[0] > done and last - h > len(triggers):
                yield name, "HTG", [q for q in left[2] if q > h], triggers, self.support(left[1], done, last)
                done = last
            p = after


def machines(configs: list[dict]) -> dict[str, Machine]:
    out: dict[str, Machine] = {}
    for c in configs:
        out.setdefault(c["head_role"], Machine(c["head_role"])).add(c)
    return out


_PLACE = "struct<pos:int,item:string,tag:string>"
_FOUND = f"group string, src string, head {_PLACE}, tails array<{_PLACE}>, triggers array<{_PLACE}>, support array<{_PLACE}>"
_PIECE, _ROWS = 1 << 17, 1 << 13  # fixed values: about so many tokens are looked at together; a batch has so many relations or eight times the places


class Relations:
    """Relations found in sentences from `starts` on, and their columns."""

    def __init__(self, tokens: Tokens, starts: np.ndarray):
        self.tokens, self.starts, self.tags = tokens, starts, pa.array(tokens.tags, pa.string())
        self.rows: list[tuple] = []
        self.places = 0

    def add(self, row: int, name: str, src: str, head: int, *parts: list[int]) -> bool:
        """True if there are enough for a batch."""
        self.rows.append((row, name, src, head, *parts))
        self.places += len(parts[0]) + len(parts[1]) + len(parts[2])
        return len(self.rows) >= _ROWS or self.places >= 8 * _ROWS

    def structs(self, at: np.ndarray, row: np.ndarray) -> pa.StructArray:
        return pa.StructArray.from_arrays([pa.array((at - self.starts[row]).astype(np.int32)), self.tokens.items.take(pa.array(self.tokens.item[at])),
                                           self.tags.take(pa.array(self.tokens.tag[at]))], ["pos", "item", "tag"])

    def lists(self, of: tuple[list[int], ...], row: np.ndarray) -> pa.ListArray:
        n = np.fromiter(map(len, of), np.int64, len(of))
        at = np.fromiter(chain.from_iterable(of), np.int64, n.sum())
        return pa.ListArray.from_arrays(pa.array(np.append(0, n.cumsum()).astype(np.int32)), self.structs(at, row.repeat(n)))

    def taken(self) -> tuple[np.ndarray, list[pa.Array]]:
        """The sentence of each relation and their columns; then there are none."""
        row, name, src, head, *parts = zip(*self.rows)
        row, head = np.array(row), np.array(head)
        self.rows, self.places = [], 0
        return row, [pa.array(name, pa.string()), pa.array(src, pa.string()), self.structs(head, row), *[self.lists(x, row) for x in parts]]


def pieces(lengths: np.ndarray):
    """(first, behind the last) sentence of each piece of about _PIECE tokens."""
    ends, lo = lengths.cumsum(), 0
    while lo < len(lengths):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + _PIECE, "right")))
        yield lo, hi
        lo = hi


def relations_of(sentences: pa.Array, by_head: dict[str, Machine]):
    """(sentence of each, columns) of the relations in sentences that are arrays of item and tag, some thousands at a time."""
    lengths = np.array(pc.fill_null(pc.list_value_length(sentences), 0))
    for first, behind in pieces(lengths):
        flat = sentences.slice(first, behind - first).flatten()
        if not len(flat):
            continue
        tokens = Tokens(pc.struct_field(flat, "item"), pc.struct_field(flat, "tag"))
        bounds = np.append(0, lengths[first:behind].cumsum())
        walks = {m.head: w for m in by_head.values() if len((w := Walk(m, tokens)).triggers) > 1}
        machine = [by_head.get(tag) or by_head.get(tag.split("_")[0]) for tag in tokens.tags]
        heads = np.flatnonzero(np.array([m is not None and m.head in walks for m in machine], bool)[tokens.tag])
        rows = np.searchsorted(bounds, heads, "right") - 1
        found = Relations(tokens, bounds)
        for h, row, lo, end, tag in zip(heads.tolist(), rows.tolist(), bounds[rows].tolist(), bounds[rows + 1].tolist(), tokens.tag[heads].tolist()):
            m = machine[tag]
            for name, src, tails, triggers, helped in walks[m.head].relations(h, lo, end):
                group = m.groups[name]
                turned = tails if group.relative or group.reverse else ()
                for t in turned:
                    if found.add(row, group.relative or name, "REVERSE" if group.relative else src, t, [h], triggers, helped):
                        at, columns = found.taken()
                        yield at + first, columns
                if not group.reverse and found.add(row, name, src, h, tails, triggers, helped):
                    at, columns = found.taken()
                    yield at + first, columns
        if found.rows:
            at, columns = found.taken()
            yield at + first, columns


def mine_relations(sentences: DataFrame, key: str, items: str, configs: list[dict]) -> DataFrame:
    """(key, group, src, head, tails, triggers, support) from tagged tokens, array<struct<item, tag>>; places are structs of pos, item, tag.

    configs are dicts of head_role, group, trig_word, trig_type (role: the word is the tail itself), tail_role (dicts of main and
    support tags), reverse and, if the other direction has a name, rel_group. A tag fits by itself or by what stands before its
    first _. Every head looks for triggers behind it: a tail is to the right of the trigger (src HGT), else between head and
    trigger (HTG), or the trigger itself (TAIL); items joined by a sign or a conjunction belong together. Turned relations have a
    row per tail. Dates count as times whatever their tag. A null or empty sentence has no relations. No shuffle; a task holds one
    Arrow batch, the codes of some sentences of it and some thousands of their relations.
    """
    by_head = machines(configs)
    rows = sentences.select(F.col(key).alias("_key"), F.col(items).alias("_items"))
    schema = T.StructType([rows.schema["_key"], *T.StructType.fromDDL(_FOUND)])
    names = schema.names

    def run(batches):
        for batch in batches:
            for at, columns in relations_of(batch.column(1), by_head):
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), *columns], names)

    found = rows.mapInArrow(run, schema)
    return found.select(F.col("_key").alias(key), *names[1:])
