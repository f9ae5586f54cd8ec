"""JSON payloads made of conversation turns, with fields of wrong types mixed in.

Every line of a turn is a reading group; its words are example words. What a
user wrote carries a digit string where a rank belongs, and its groups have no
usable words; a system turn has a key of two letters; totals depend on the role.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import evened
from ..sources.payloads import parsed
from .base import HIRA, KATA, LETTERS, WORD, hira, kata, table, word_list

# Word fields: rank grows with length and first letter; words that end in n are too
# rare, those of three letters have a digit string, those of two a boolean.
_RANK = """
case when length(w) = 3 then concat('"', length(w), '"') when length(w) = 2 then 'true'
     when length(w) = 1 then '2.5' when right(w, 1) = 'n' then cast(100000 + length(w) as string)
     else cast(100 * length(w) + ascii(w) as string) end"""


def _word_json(words: str, broken: bool) -> str:
    ruby = "w, '['" if broken else f"w, '[', translate(w, '{LETTERS}', '{HIRA}'), ']'"
    return f"""concat('[7,', array_join(transform({words}, (w, i) -> concat(
        '{{"wordId":', length(w), ',"readingIndex":', case when i % 4 = 3 then '"x"' else cast(i % 3 as string) end,
        ',"reading":" ', w, '  ","readingFurigana":"', {ruby},
        '","mainDefinition":"', if(startswith(w, 'q'), '<i>', concat('the ', w)), '","frequencyRank":', {_RANK}, '}}')), ','),
        if(size({words}) > 0, ',', ''), 'null]')"""


def turn_payloads(spark, sf) -> DataFrame:
    """``key, v`` of every conversation turn."""
    return parsed(turn_json(spark, sf))


def turn_json(spark, sf) -> DataFrame:
    turns = evened(table(spark, sf, "conversations"))
    lines = F.transform(F.split("text", "\n"), word_list)
    rows = turns.select(
        F.concat_ws("-", "conv_id", "turn").alias("key"), "turn", "role",
        lines.alias("lines"), word_list("text").alias("words"),
    )
    rows = rows.select(
        "*",
        F.get("lines", 0).alias("first"), F.get("lines", F.size("lines") - 1).alias("final"),
        F.get("words", 0).alias("w0"),
    )

    def strings(words, f):
        return F.to_json(F.transform(words, f))

    def group(i):
        return f"""concat('{{"reading":"', translate(coalesce(get(l, 0), '<'), '{LETTERS}', '{KATA}'), '","totalWords":',
            case role when 'assistant' then cast(size(l) - 2 as string) when 'user' then concat('"', size(l), '"') else 'true' end,
            ',"words":', if(role = 'user', {_word_json('l', True)}, {_word_json('l', False)}), '}}')"""

    groups = F.expr(f"concat('[', array_join(transform(lines, l -> {group('l')}), ','), ',5]')")
    top = F.expr(_word_json("first", False))
    json = F.concat(
        F.lit('{"character":"'), F.when(F.col("role") == "system", F.left("w0", F.lit(2))).otherwise(F.left("w0", F.lit(1))),
        F.lit('","meanings":'), F.concat(F.regexp_replace(strings("first", lambda w: F.concat(F.lit("to "), w)), r"\]$", ""),
                                        F.when(F.size("first") > 0, ',"missing",5,"a <b>"]').otherwise("]")),
        F.lit(',"onReadings":'), strings("first", kata), F.lit(',"kunReadings":'), strings("final", hira),
        F.lit(',"frequencyRank":'),
        F.when(F.col("role") == "user", '"7"').otherwise((F.col("turn") - 1).cast("string")),
        F.lit(',"strokeCount":'), F.size("lines").cast("string"),
        F.lit(',"grade":'), F.when(F.col("role") == "assistant", "2.0").otherwise("3"),
        F.lit(',"jlptLevel":'), (F.col("turn") % 7).cast("string"),
        F.lit(',"wordsByReading":'), groups, F.lit(',"topWords":'), top, F.lit("}"),
    )
    return rows.select("key", json.alias("json"))


SQL_TURNS = f"""
turns AS (SELECT conv_id || '-' || turn AS key, turn, role,
            regexp_extract_all(lower(text), '{WORD}')[1] AS w0,
            list_transform(string_split(text, chr(10)), lambda l: regexp_extract_all(lower(l), '{WORD}')) AS lines
          FROM conversations)"""

SQL_PAYLOAD_WORDS = f"""{SQL_TURNS},
lists AS (SELECT key, role, -1 AS grp, CAST(NULL AS VARCHAR) AS label, lines[1] AS ws FROM turns
          UNION ALL
          SELECT key, role, grp - 1, translate(ws[1], '{LETTERS}', '{KATA}'), ws
          FROM (SELECT key, role, unnest(lines) AS ws, generate_subscripts(lines, 1) AS grp FROM turns)),
listed AS (SELECT key, role, grp, label, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM lists),
clean AS (SELECT key, CAST(grp AS BIGINT) AS grp, label, CAST(pos AS BIGINT) AS pos, w AS surface, 'the ' || w AS gloss,
            CAST(100 * length(w) + unicode(w) AS BIGINT) AS rank, length(w) AS word_id,
            CAST(CASE WHEN (pos - 1) % 4 = 3 THEN 0 ELSE (pos - 1) % 3 END AS BIGINT) AS reading_index,
            translate(w, '{LETTERS}', '{HIRA}') AS reading
          FROM listed
          WHERE length(w) > 3 AND w[-1] <> 'n' AND w[1] <> 'q' AND (role <> 'user' OR grp = -1))"""
