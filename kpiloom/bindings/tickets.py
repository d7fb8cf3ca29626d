"""Support tickets on ``documents``: a document is a message, tags are put before its whole text.

Tags go by the length of the text; Spanish documents are comments without a number.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from kpiloom import fixed_values as fv
from kpiloom.bindings.inputs import steps, steps_sql, table
from kpiloom.operators.rows import skip_first
from kpiloom.plans import tickets as T

LINK = "https://chat.example/c/1/"
COMMENT = "Уточнение {} без номера "
HEADS = (
    (600, "Заявка № {} #ОСП 3 #ЕМИАС #Открыта\n"),
    (900, "Заявка  №{} #ОСП_1 #ОСП_2 #Оснащение #Решена "),
    (1300, "Заявка N{} #Кирова #Проект #решено "),
    (1800, "Заявка N {} #Общая #ОСП_4 #ЦАОП #Закрыта\n"),
    (2500, "Заявка №{} #ОСП №3 #Списание "),
)
LONG_HEAD = "Заявка №{} #Ленинград #ЕМИАС #Проект #закрыта "


def messages(spark, folder):
    """English documents are plain strings, the others lists of text parts."""
    key, lang = F.col("doc_id"), F.col("lang")
    tags = F.when(lang == "es", COMMENT).otherwise(steps(F.col("n_chars"), HEADS, LONG_HEAD))
    head = F.replace(tags, F.lit("{}"), key.cast("string"))
    body = F.col("text")
    plain = F.concat(head, body).cast("variant")
    parts = F.to_variant_object(
        F.array(
            F.struct(F.lit("bold").alias("type"), head.alias("text")),
            F.struct(F.lit("plain").alias("type"), body.alias("text")),
        )
    )
    return table(spark, folder, "documents").select(
        key.alias("id"),
        F.when(F.col("source") != "src0", F.col("source")).alias("author"),
        F.when(lang == "en", plain).otherwise(parts).alias("text"),
    )


def found(spark, folder):
    return T.tickets(messages(spark, folder), link_base=LINK)


def ticket_status_counts(spark, folder):
    return T.ticket_status_counts(found(spark, folder))


def ticket_open_by_group(spark, folder):
    return T.open_by_group(found(spark, folder))


def conversation_after_intro(spark, folder):
    """Turns of each conversation after its introductory ones."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return skip_first(turns, ["conv_id"], ["turn"], fv.TICKET_INTRO_RECORDS)


QUERIES = {
    "conversation_after_intro": conversation_after_intro,
    "ticket_fields": found,
    "ticket_status_counts": ticket_status_counts,
    "ticket_open_by_group": ticket_open_by_group,
}

_HEAD_SQL = f"CASE WHEN lang = 'es' THEN '{COMMENT}' ELSE {steps_sql('n_chars', HEADS, LONG_HEAD)} END"
_SPELLINGS = (
    ("Заявка № ", "Заявка №"), ("Заявка  №", "Заявка №"), ("Заявка N ", "Заявка №"), ("Заявка N", "Заявка №"),
    ("#Открыта", "#Открыто"), ("#Решена", "#Решено"), ("#решено", "#Решено"), ("#Закрыта", "#Решено"),
    ("#ОСП ", "#ОСП_"), ("#ОСП №", "#ОСП_"),
)
_TEXT_SQL = f"replace(replace({_HEAD_SQL}, '{{}}', CAST(doc_id AS VARCHAR)) || text, chr(10), ' ')"
for _old, _new in _SPELLINGS:
    _TEXT_SQL = f"replace({_TEXT_SQL}, '{_old}', '{_new}')"


def _tags_sql(pairs) -> str:
    return "[" + ", ".join(f"CASE WHEN contains(t, '{tag}') THEN '{label}' END" for tag, label in pairs) + "]"


_TICKETS_SQL = f"""m AS (SELECT doc_id, source, {_TEXT_SQL} AS t FROM documents WHERE source <> 'src0'),
  tickets AS (
    SELECT CAST(nullif(regexp_extract(t, 'Заявка №([0-9]+)', 1), '') AS BIGINT) AS number, '{LINK}' || doc_id AS url, source AS author,
           CASE WHEN contains(t, '#Решено') THEN 'Решено' ELSE 'Открыто' END AS status,
           array_to_string(list_concat(regexp_extract_all(t, '#(ОСП_[0-9])', 1), list_filter({_tags_sql(
               (("#Кирова", "Кирова_38"), ("#Ленинград", "Ленинградская_9"), ("#ЦАОП", "ЦАОП"), ("#Общая", "Общая")))},
               lambda z: z IS NOT NULL)), ', ') AS "group",
           array_to_string(list_filter({_tags_sql((("#ЕМИАС", "ЕМИАС"), ("#Оснащение", "Оснащение"), ("#Списание", "Списание"), ("#Проект", "Проект")))},
               lambda z: z IS NOT NULL), ', ') AS theme, t AS text
    FROM m WHERE regexp_matches(t, 'Заявка №[0-9]+'))"""

ORACLES = {
    "conversation_after_intro": f"""SELECT conv_id, turn, role, text FROM conversations
        QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) > {fv.TICKET_INTRO_RECORDS}""",
    "ticket_fields": f"WITH {_TICKETS_SQL} SELECT * FROM tickets",
    "ticket_status_counts": f"WITH {_TICKETS_SQL} SELECT status, count(number) AS tickets FROM tickets GROUP BY status",
    "ticket_open_by_group": f"""WITH {_TICKETS_SQL} SELECT "group", count(number) AS open_tickets FROM tickets
        WHERE status = 'Открыто' GROUP BY "group\"""",
}
