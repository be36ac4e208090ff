"""Secret scans through a trigram inverted index.

From each rule's regular expression a Boolean query over trigrams is derived: an
OR of clauses, each an AND of trigrams that any match must hold (in lower case).
The index lists, for every trigram that some query names, the documents whose
lower-cased text has it.  Postings are intersected by clause, and only documents
of some clause are verified by the rule's expression.  A rule from which no
mandatory trigram follows is run over every document.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as sre
from re import _parser as sre_parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import written

MAX_STRINGS = 64
MAX_CLAUSES = 32
BLOCK = 256


@dataclass(frozen=True)
class Rule:
    """``kind`` names the spans; ``pattern`` must read alike in Java and Python;
    a match counts if its group ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: Fixed rules (the base), in the order in which equal starts are listed.  For
#: access and hex the least length stands in the expression: a run of one
#: character class that is long enough matches from its start either way.
BASE_RULES = (
    Rule("assign", "(?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 1, 12),
    Rule("access", "AKIA[A-Z0-9]{14,}"),
    Rule("hex", "[0-9a-f]{16,}"),
)
MORE_RULES = (
    Rule("github", "gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", "AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", "[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("jwt", "eyJ[A-Za-z0-9_-]{10,}\\.eyJ[A-Za-z0-9_-]{10,}\\.[A-Za-z0-9_-]*"),
    Rule("private_key", "-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("url_login", "[a-z][a-z0-9+.-]{1,20}://[^\\x00-\\x20:@/]{1,64}:[^\\x00-\\x20:@/]{1,128}@"),
)

Clauses = frozenset  # of frozensets of trigrams; a clause without trigrams: any text
ANY: Clauses = frozenset([frozenset()])


# From expression to trigram query --------------------------------------------

def trigram_query(pattern: str) -> Clauses:
    """The trigram query of a regular expression, in lower case."""
    strings, query = _sequence(sre_parser.parse(pattern))
    return _and(query, _of_strings(strings)) if strings is not None else query


def _of_strings(strings: frozenset) -> Clauses:
    """OR over strings of all trigrams of each."""
    return _simple(frozenset(frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings))


def _simple(clauses: Clauses) -> Clauses:
    """Without clauses that another clause implies."""
    return frozenset(c for c in clauses if not any(other < c for other in clauses))


def _and(a: Clauses, b: Clauses) -> Clauses:
    both = _simple(frozenset(x | y for x in a for y in b))
    return both if len(both) <= MAX_CLAUSES else a if len(a) <= len(b) else b


def _sequence(nodes) -> tuple[frozenset | None, Clauses]:
    """(all strings that match, or None if too many; query)."""
    strings, query, whole = frozenset([""]), ANY, True
    for node in nodes:
        some, inner = _node(node)
        query = _and(query, inner)
        if some is not None and len(strings) * len(some) <= MAX_STRINGS:
            strings = frozenset(a + b for a in strings for b in some)
            continue
        query = _and(query, _of_strings(strings))
        whole = False
        strings = some if some is not None else frozenset([""])
    return (strings, query) if whole else (None, _and(query, _of_strings(strings)))


def _node(node) -> tuple[frozenset | None, Clauses]:
    kind, value = node
    if kind is sre.LITERAL:
        return frozenset([chr(value).lower()]), ANY
    if kind is sre.IN:
        chars: set[str] = set()
        for what, x in value:
            if what is sre.LITERAL:
                chars.add(chr(x).lower())
            elif what is sre.RANGE and x[1] - x[0] < 8:
                chars.update(chr(c).lower() for c in range(x[0], x[1] + 1))
            else:
                return None, ANY
        return (frozenset(chars), ANY) if len(chars) <= 8 else (None, ANY)
    if kind is sre.SUBPATTERN:
        return _sequence(value[-1])
    if kind is sre.BRANCH:
        found = [_sequence(branch) for branch in value[1]]
        if all(s is not None for s, _ in found) and sum(len(s) for s, _ in found) <= MAX_STRINGS:
            return frozenset().union(*(s for s, _ in found)), ANY
        return None, _simple(frozenset().union(*(_and(q, _of_strings(s)) if s is not None else q for s, q in found)))
    if kind in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        least, most, inner = value
        some, query = _sequence(inner)
        if (least, most) == (0, 1) and some is not None:
            return some | {""}, ANY
        if least == most == 1:
            return some, query
        if least == 0:
            return None, ANY
        return None, _and(query, _of_strings(some)) if some is not None else query
    if kind is sre.AT:
        return frozenset([""]), ANY
    return None, ANY


# The index -------------------------------------------------------------------

def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """(trigram, doc_id) for the given trigrams, from lower-cased whole texts.

    Each text is lowered once and searched in compiled code, and the lists are
    written before they are unfolded: otherwise the optimizer would search every
    text again, and lower it for each trigram, to drop texts without any.
    """
    has = docs.select("doc_id", F.lower(F.coalesce(F.col("text"), F.lit(""))).alias("_t")).select(
        "doc_id", F.array_compact(F.array(*[F.when(F.contains(F.col("_t"), F.lit(t)), F.lit(t)) for t in trigrams])).alias("_has"))
    return written(has, "trigram_lists").select(F.explode("_has").alias("trigram"), "doc_id")


def candidates(index: DataFrame, queries: dict[str, Clauses]) -> DataFrame:
    """(doc_id, kinds): the rules of which some clause has all its trigrams in
    the document; one row per doc_id."""
    rows = [(kind, n, trigram, 1 << k, (1 << len(clause)) - 1)
            for kind, clauses in sorted(queries.items())
            for n, clause in enumerate(sorted(map(sorted, clauses)))
            for k, trigram in enumerate(clause)]
    wanted = index.sparkSession.createDataFrame(rows, "kind string, clause int, trigram string, bit long, full long")
    met = index.join(F.broadcast(wanted), "trigram")  # as many rows as the rules name trigrams
    clauses = met.groupBy("doc_id", "kind", "clause", "full").agg(F.bit_or("bit").alias("bits"))
    return (clauses.where("bits = full").groupBy("doc_id").agg(F.collect_set("kind").alias("kinds")))


# Verification ----------------------------------------------------------------

def with_spans(rows: DataFrame, chosen: list[Column], rules: tuple[Rule, ...]) -> DataFrame:
    """``rows`` with ``spans``: array of (start, rank, end, kind) of the matches
    of every rule where ``chosen`` holds, leftmost first and not overlapping per
    rule, sorted by start and rank; code points, end exclusive.

    A match begins after the lengths of all pieces and matches before it.  The
    running sums go in two levels, so texts with very many matches stay cheap.
    """
    text = F.col("text")
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)
    col = lambda name, k: F.col(f"_{name}{k}")
    blocks = lambda k: F.sequence(F.lit(0), F.floor((F.size(col("found", k)) - 1) / BLOCK).cast("int"))
    every = list(enumerate(rules))
    rows = rows.withColumns({f"_found{k}": F.when(chosen[k], F.regexp_extract_all(text, F.lit(r.pattern), 0)) for k, r in every})
    some = [F.size(col("found", k)) > 0 for k, _ in every]
    rows = rows.withColumns({f"_piece{k}": F.when(some[k], F.split(text, r.pattern, -1)) for k, r in every})
    rows = rows.withColumns({f"_value{k}": F.when(some[k], F.regexp_extract_all(text, F.lit(r.pattern), r.group))
                             for k, r in every if r.group})
    rows = rows.withColumns({f"_step{k}": F.when(some[k], F.zip_with(
        F.slice(col("piece", k), 1, F.size(col("found", k))), col("found", k),
        lambda a, b: (F.length(a) + F.length(b)).cast("long"))) for k, _ in every})
    sums = lambda k: F.transform(blocks(k), lambda b: total(F.slice(col("step", k), b * BLOCK + 1, BLOCK)))
    rows = rows.withColumns({f"_sum{k}": F.when(some[k], sums(k)) for k, _ in every})

    def spans(k: int, rule: Rule) -> Column:
        found, piece, step = col("found", k), col("piece", k), col("step", k)
        value = col("value", k) if rule.group else found

        def of_block(b):
            base = total(F.slice(col("sum", k), 1, b))

            def one(i):
                start = base + total(F.slice(step, b * BLOCK + 1, i - b * BLOCK)) + F.length(F.get(piece, i))
                span = F.struct(start.alias("start"), F.lit(k).alias("rank"),
                                (start + F.length(F.get(found, i))).alias("end"), F.lit(rule.kind).alias("kind"))
                return F.when(F.length(F.get(value, i)) >= rule.least, span)

            return F.transform(F.sequence(b * BLOCK, F.least(F.size(found), (b + 1) * BLOCK) - 1), one)

        return F.when(some[k], F.array_compact(F.flatten(F.transform(blocks(k), of_block))))

    rows = rows.withColumns({f"_spans{k}": spans(k, r) for k, r in every})
    none = F.array().cast(NO_SPANS)
    return rows.withColumn("spans", F.array_sort(F.concat(*[F.coalesce(col("spans", k), none) for k, _ in every])))


NO_SPANS = "array<struct<start:bigint,rank:int,end:bigint,kind:string>>"


def joined(spans: Column) -> Column:
    """``kind:start:end`` of the spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES) -> DataFrame:
    """(doc_id, text, spans) per row of ``docs``; spans by start, then rule.

    A null text counts as empty.  Repeated rows and ids keep their rows (the
    index works by doc_id, null included, and may only name too many texts).
    Other columns of ``docs`` are not read.
    """
    docs = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    queries = {kind: q for kind, q in queries.items() if frozenset() not in q}
    trigrams = sorted({t for q in queries.values() for clause in q for t in clause})
    rows = docs.withColumn("kinds", F.array().cast("array<string>"))
    if trigrams:
        index = postings(docs, trigrams)
        found = written(candidates(index, queries).withColumnRenamed("doc_id", "_d"), "trigram_candidates")
        rows = docs.join(found, docs["doc_id"].eqNullSafe(found["_d"]), "left").drop("_d")
    chosen = [F.array_contains("kinds", r.kind) if r.kind in queries else F.col("text").rlike(r.pattern) for r in rules]
    return with_spans(rows, chosen, rules).select("doc_id", "text", "spans")


def secret_digests(scanned: DataFrame) -> DataFrame:
    """Counts, digest of the base spans, and all spans as text, per row."""
    base = [r.kind for r in BASE_RULES]
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    own = F.filter("spans", lambda s: s["kind"].isin(base))
    return scanned.select("doc_id", *[count(k).alias(f"n_{k}") for k in base],
                          F.sha2(joined(own), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
