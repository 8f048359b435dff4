"""Licence scans: Dice coefficient over word bigrams between parts of a text and licence templates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.functions.text import let
from catalith.llm.common import digest, documents

# Wordings that licences ask for, as published.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "mit-line": "Released under the MIT License.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-4.0-line": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-line": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        'copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY '
        "KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
        "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
        "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE "
        "FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS "
        "OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING "
        "OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    "gpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details. You should have received a copy of the GNU General Public "
        "License along with this program. If not, see <https://www.gnu.org/licenses/>."),
}
SEPARATORS = r"[^\p{L}\p{N}]+"
PARAGRAPH = r"\n[ \t\r]*\n"


def normalised(text: Column) -> Column:
    """Lower case, runs of anything but letters and digits as one blank."""
    return F.trim(F.regexp_replace(F.lower(text), SEPARATORS, " "))


def bigrams(text: Column) -> Column:
    """Distinct pairs of neighbouring words of a normalised text."""
    return let(F.split(text, " "), lambda words: F.array_distinct(F.zip_with(
        F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.size(words)),
        lambda a, b: F.concat_ws(" ", a, b))))


def built_in_templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TEMPLATES.items()), "template string, text string")


def needed_pairs(pairs: list[str], threshold: float) -> int:
    """So many of a template's pairs that a text which reaches ``threshold`` has one of them, whichever they are.

    Such a text has at least t / (2 - t) of the template's pairs; this is one more than it may lack.
    """
    return int(len(pairs) * (1 - threshold / (2 - threshold)) + 1e-9) + 1


def rare_pairs(pairs: list[str], threshold: float) -> list[str]:
    """The longest pairs, as the rarer ones, of which every text that reaches ``threshold`` has one."""
    return sorted(pairs, key=lambda p: (-len(p), p))[: needed_pairs(pairs, threshold)]


def anchors(pairs: list[str], threshold: float) -> list[tuple[str, ...]]:
    """Words, or pairs of words, of which every text that reaches ``threshold`` has one entry whole.

    The entries touch as many pairs as are needed.  Words of six letters and more that touch most pairs are
    taken first; where they do not suffice, both words of further pairs.
    """
    need = needed_pairs(pairs, threshold)
    left, chosen = [tuple(p.split(" ")) for p in pairs], []
    for word in sorted({w for p in left for w in p if len(w) >= 6}, key=lambda w: (-sum(w in p for p in left), w)):
        if len(pairs) - len(left) >= need:
            return chosen
        chosen.append((word,))
        left = [p for p in left if word not in p]
    more = sorted(left, key=lambda p: (-len(p[0]) - len(p[1]), p))
    return chosen + more[: max(0, need - (len(pairs) - len(left)))]


def may_match(text: Column, lists: list[list[str]], threshold: float) -> Column:
    """Necessary for any match: an anchor's words occur anywhere in the lowered text, and a rare pair in the normalised one."""
    entries = sorted({e for pairs in lists for e in anchors(pairs, threshold)})

    def any_of(lowered: Column) -> Column:
        out = F.lit(False)
        for entry in entries:
            whole = F.contains(lowered, F.lit(entry[0]))
            out = out | (whole & F.contains(lowered, F.lit(entry[1])) if len(entry) > 1 else whole)
        return out

    rare = sorted({p for pairs in lists for p in rare_pairs(pairs, threshold)})
    known = F.array(*map(F.lit, rare)).cast("array<string>")
    return let(F.lower(text), any_of) & F.arrays_overlap(bigrams(normalised(text)), known)


def licence_scan(
    docs: DataFrame, templates: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text",
    max_templates: int = 5000,
) -> DataFrame:
    """Licences found in each document: id_col, template, n_parts, best_dice.

    Compared are the whole text, each line and each paragraph (between blank lines), normalised; a
    part matches a template if 2 * common / (its distinct word pairs + the template's) reaches
    ``threshold``.  A template is a candidate only if the part's number of pairs lies between
    t / (2 - t) and (2 - t) / t times its own.  Texts without any anchor (``may_match``, a necessary
    condition) are left out before they are cut into parts, and each distinct part is compared once,
    through the word pairs it shares with templates.

    The templates' pairs come to the driver once to choose the anchors; more than ``max_templates``
    templates are an error.  Rows that share an id count together, a missing id is one of its own; missing
    and empty texts and templates of less than two words match nothing; other columns are not read.
    """
    # distinct template texts under a bound that is checked
    pairs = templates.where("template IS NOT NULL").select(
        "template", bigrams(normalised(F.coalesce(F.col("text"), F.lit("")))).alias("pairs")).where(
        F.size("pairs") > 0).limit(max_templates + 1).collect()
    if len(pairs) > max_templates:
        raise ValueError(f"more than {max_templates} templates")
    may = may_match(F.col(text_col), [r.pairs for r in pairs], threshold)
    text = F.col(text_col)
    parts = F.array_distinct(F.concat(F.array(text), F.split(text, "\n", -1), F.split(text, PARAGRAPH, -1)))
    units = (
        docs.where(may).select(F.col(id_col).alias("id"), F.explode(parts).alias("part"))
        .select("id", normalised(F.col("part")).alias("part"))
        .where(F.contains("part", F.lit(" "))).select("id", "part", digest(F.col("part")).alias("key")))
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    sized = docs.sparkSession.createDataFrame(
        [(r.template, p, len(r.pairs)) for r in pairs for p in r.pairs] or [], "template string, pair string, m int")
    distinct = (
        units.groupBy("key").agg(F.first("part").alias("part")).withColumn("pairs", bigrams(F.col("part")))
        .select("key", F.size("pairs").alias("n"), "pairs")
        .where(F.col("n").between(low * min((len(r.pairs) for r in pairs), default=0) - 1e-9,
                                  high * max((len(r.pairs) for r in pairs), default=0) + 1e-9)))
    hits = (
        distinct.select("key", "n", F.explode("pairs").alias("pair")).join(sized, "pair")
        .where(F.col("n").between(low * F.col("m") - 1e-9, high * F.col("m") + 1e-9))
        .groupBy("key", "template", "n", "m").agg(F.count("*").alias("common"))
        .withColumn("dice", 2 * F.col("common") / (F.col("n") + F.col("m"))).where(F.col("dice") >= threshold)
        .select("key", "template", "dice"))
    return (
        units.select("id", "key").join(hits, "key").groupBy("id", "template")
        .agg(F.countDistinct("key").alias("n_parts"), F.max("dice").alias("best_dice"))
        .withColumnRenamed("id", id_col))


def op4_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all documents, by the built-in templates."""
    return licence_scan(documents(spark, sf_dir, "doc_id", "text"), built_in_templates(spark))


_NORMAL = "trim(regexp_replace(lower({}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
_PAIRS = (
    "list_distinct(list_transform(range(1, len(string_split({0}, ' '))), "
    "lambda i: string_split({0}, ' ')[i] || ' ' || string_split({0}, ' ')[i + 1]))")
SQL = """
WITH templates(template, raw) AS (VALUES {values}
), t AS (
  SELECT template, {template_pairs} AS pairs FROM (SELECT template, {template_text} AS text FROM templates)
), parts AS (
  SELECT DISTINCT doc_id, {part_text} AS part FROM (
    SELECT doc_id, text AS part FROM documents
    UNION ALL SELECT doc_id, unnest(string_split(text, chr(10))) FROM documents
    UNION ALL SELECT doc_id, unnest(regexp_split_to_array(text, '\\n[ \\t\\r]*\\n')) FROM documents)
), p AS (
  SELECT doc_id, part, {part_pairs} AS pairs FROM parts WHERE contains(part, ' ')
), scored AS (
  SELECT doc_id, part, template, 2 * len(list_intersect(p.pairs, t.pairs)) / (len(p.pairs) + len(t.pairs)) AS dice
  FROM p JOIN t ON len(p.pairs) BETWEEN 2 / 3 * len(t.pairs) - 1e-9 AND 1.5 * len(t.pairs) + 1e-9
)
SELECT doc_id, template, count(DISTINCT part) AS n_parts, max(dice) AS best_dice
FROM scored WHERE dice >= 0.8 GROUP BY doc_id, template
""".format(
    values=", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in TEMPLATES.items()),
    template_text=_NORMAL.format("raw"), template_pairs=_PAIRS.format("text"),
    part_text=_NORMAL.format("part"), part_pairs=_PAIRS.format("part"))
