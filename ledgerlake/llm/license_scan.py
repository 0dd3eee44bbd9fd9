"""Operator 5: licences by sentence rules, in DataFrame functions only.

Sentences are normalised (ASCII letters and digits, lower case, single
spaces) and looked up among the known licence sentences.  A document becomes
the sequence of the identifiers found; a licence is reported when one of its
rules occurs in the sequence in the rule's order.  A text is cut twice: at
line ends and sentence ends, and at sentence ends only with line ends as
spaces (wrapped licence texts).  These two sequences are reported.  Published
texts put cuts inside the known sentences and lines without a full stop around
them, so a licence is also reported when its rule occurs in the text's pieces:
there a known sentence starts and ends at a cut (line end, sentence end, URL or
list number) and may span any number of cuts.  Every row is processed in place:
no shuffle.

Defined results: null, empty and licence-free texts give no row; of a rule's
sentences other sentences may stand between; a licence is reported once per
row; repeated rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import table, text_of
from ledgerlake.llm.license_rules import ANCHORS, PUBLISHED, PUBLISHED_ANCHORS, PUBLISHED_RULES, RULES, SENTENCES

_ENDS = "[.!?:;]+[ \\t\\r\\n]+"
_LINES = "[\\r\\n]+|" + _ENDS
_ANCHOR = "|".join(ANCHORS)
_WANTED = "|".join(dict.fromkeys(ANCHORS + PUBLISHED_ANCHORS)).replace(" ", "[^a-z0-9]+")
_PIECE_ENDS = ("[\\r\\n]+[^A-Za-z0-9\\r\\n]*[0-9A-Za-z]{1,2}[.)][ \\t]+|[\\r\\n]+|"
               "[.!?:;]+[\"')\\]]*[ \\t\\r\\n]+|https?://\\S+")


def _clean(sentence: Column) -> Column:
    return F.trim(F.lower(F.regexp_replace(sentence, "[^A-Za-z0-9]+", " ")))


def identifiers(text: Column, cut: str) -> Column:
    """Identifiers of the known sentences of a text, in order, as ``<a><b>``."""
    known = F.create_map(*[F.lit(x) for i, s in SENTENCES.items() for x in (s, f"<{i}>")])
    sentences = F.filter(F.transform(F.split(text, cut), _clean), lambda s: s.rlike(_ANCHOR))
    return F.array_join(F.filter(F.transform(sentences, lambda s: F.try_element_at(known, s)),
                                 lambda i: i.isNotNull()), "")


def pieces(text: Column) -> Column:
    """The normalised text with its cuts, as ``|words|words|``."""
    marked = F.regexp_replace(F.translate(text, "|", " "), _PIECE_ENDS, "|")
    words = F.lower(F.regexp_replace(marked, "[^A-Za-z0-9|]+", " "))
    return F.regexp_replace(F.concat(F.lit("|"), words, F.lit("|")), " ?\\|[ |]*", "|")


def _in_pieces(rule: list[str]) -> str:
    """Regular expression of a rule: its sentences in order, each at its first place (linear time)."""
    known = SENTENCES | PUBLISHED
    return "^" + "".join("(?>.*?\\|" + known[i].replace(" ", "[ |]") + "(?=\\|))" for i in rule)


def licences(cut: Column, *sequences: Column) -> Column:
    """Names of the licences of which a rule occurs in the pieces or in one of the sequences, sorted."""
    def holds(name: str, rules: list[list[str]]) -> Column:
        out = F.lit(False)
        for rule in rules + PUBLISHED_RULES.get(name, []):
            out = out | cut.rlike(_in_pieces(rule))
        for rule in rules:
            for s in sequences:
                out = out | s.like("%" + "%".join(f"<{i}>".replace("_", "\\_") for i in rule) + "%")
        return out
    return F.array_compact(F.array(*[F.when(holds(name, rules), F.lit(name)) for name, rules in sorted(RULES.items())]))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, identifiers by line, identifiers of the unwrapped text, licences (array)."""
    wanted = docs.select("doc_id", text_of().alias("text")).where(F.lower("text").rlike(_WANTED))
    found = wanted.select("doc_id", identifiers(F.col("text"), _LINES).alias("by_line"),
                          identifiers(F.regexp_replace("text", "[\\r\\n]+", " "), _ENDS).alias("unwrapped"),
                          pieces(F.col("text")).alias("pieces"))
    named = found.select("doc_id", "by_line", "unwrapped",
                         licences(F.col("pieces"), F.col("by_line"), F.col("unwrapped")).alias("licences"))
    return named.where("by_line <> '' or unwrapped <> '' or size(licences) > 0")


def op5_license_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "by_line", "unwrapped", F.array_join("licences", ",").alias("licences"),
        F.size("licences").cast("long").alias("n_licences"))


def oracle_sql() -> str:
    """The rows that the two sequences give, in DuckDB: sentences as rows, joined with the known sentences."""
    known = ", ".join(f"('{s}', '{i}')" for i, s in SENTENCES.items())
    rules = ", ".join(f"('{name}', '%{'%'.join(f'<{i}>' for i in rule)}%')"
                      for name, all_rules in sorted(RULES.items()) for rule in all_rules)
    cuts = {"by_line": ("text", r"[\r\n]+|[.!?:;]+[ \t\r\n]+"),
            "unwrapped": (r"regexp_replace(text, '[\r\n]+', ' ', 'g')", r"[.!?:;]+[ \t\r\n]+")}
    seqs = ", ".join(f"""{name} AS (
        SELECT n, string_agg('<' || id || '>', '' ORDER BY pos) AS ids FROM (
            SELECT n, generate_subscripts(s, 1) AS pos, unnest(s) AS sentence
            FROM (SELECT n, string_split_regex({text}, '{cut}') AS s FROM numbered)) p
        JOIN known ON known.sentence = trim(lower(regexp_replace(p.sentence, '[^A-Za-z0-9]+', ' ', 'g')))
        GROUP BY n)""" for name, (text, cut) in cuts.items())
    return f"""
    WITH numbered AS (SELECT row_number() OVER () AS n, doc_id, text FROM documents
                      WHERE text IS NOT NULL),
    known(sentence, id) AS (VALUES {known}), rules(name, pattern) AS (VALUES {rules}),
    {seqs},
    found AS (SELECT n, doc_id, coalesce(a.ids, '') AS by_line, coalesce(b.ids, '') AS unwrapped
              FROM numbered LEFT JOIN by_line a USING (n) LEFT JOIN unwrapped b USING (n)
              WHERE a.ids IS NOT NULL OR b.ids IS NOT NULL),
    named AS (SELECT DISTINCT n, name FROM found JOIN rules
              ON replace(by_line, '_', '-') LIKE replace(pattern, '_', '-')
              OR replace(unwrapped, '_', '-') LIKE replace(pattern, '_', '-'))
    SELECT doc_id, by_line, unwrapped, coalesce(string_agg(name, ',' ORDER BY name), '') AS licences,
           count(name) AS n_licences
    FROM found LEFT JOIN named USING (n) GROUP BY n, doc_id, by_line, unwrapped"""
