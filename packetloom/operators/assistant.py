"""Text preparation around an assistant: routing, context, prompts, replies."""

from pyspark.sql import functions as F

from packetloom.functions.text import contains_any, strip, zoned_text
from packetloom.operators.lists import active_blocks

# Word lists, limits, prompt texts and the reasoning pattern.
SECURITY_WORDS = (
    "ip", "block", "bloccat", "firewall", "attacc", "alert", "allarm",
    "traffico", "sniffer", "sicurezza", "nids", "intrusion", "catalogo",
    "dataset", "mongo", "database", "cyber", "porta", "port", "conness",
)
GREETINGS = (
    "ciao", "buongiorno", "salve", "buonasera", "test", "hola", "hello",
    "hi", "hey", "chi sei", "aiuto",
)
SHORT_QUESTION = 15
CONTEXT_ITEMS = 5
CONTEXT_TIME = "yyyy-MM-dd HH:mm"
CONTEXT_HEAD = "\n[CONTESTO REALE DEL DATA CENTER - DA MONGO DB]\n"
BLOCKS_HEAD = "IP bloccati nel firewall edge:\n"
NO_BLOCKS = "- Nessun IP bloccato al momento.\n"
ALERTS_HEAD = "\nAllarmi di sicurezza recenti:\n"
NO_ALERTS = "- Nessun allarme recente.\n"
BLOCK_LINE = "- IP: %s | Bloccato il: %s | Motivo: %s\n"
ALERT_LINE = "- Alert: %s | Stato: %s | Severità: %s\n"
GENERIC_PROMPT = "Rispondi in lingua italiana: "
CONTEXT_PROMPT = (
    "[IMPORTANTE - RISPONDI IN LINGUA ITALIANA]\n"
    "Usa questi dati reali del Data Center per rispondere alla domanda "
    "dell'utente se pertinenti:\n"
)
QUESTION_PROMPT = "\n\nDomanda dell'utente: "
SQL_PROMPT = ("L'utente richiede: ", "\nGenera solo la query SQL, senza markdown.")
REASONING = r"(?sd)<think>(.*?)(?:</think>|$)"
REASONING_MARK = "<think>"


def route_questions(df, col, security=SECURITY_WORDS, greetings=GREETINGS):
    """Add ``is_security``, ``is_greeting`` and ``is_generic`` per question.

    Words match as substrings, so short ones also match inside others.
    """
    text = F.lower(strip(F.col(col)))
    return df.withColumns(
        {
            "is_security": contains_any(text, security),
            "is_greeting": contains_any(text, greetings),
            "is_short": F.length(text) <= SHORT_QUESTION,
        }
    ).withColumn(
        "is_generic",
        (F.col("is_short") | F.col("is_greeting")) & ~F.col("is_security"),
    ).drop("is_short")


def security_context(blocked, alerts, zone="UTC", tie_break=("source", "message")):
    """One row: the context block of newest active blocks and newest alerts.

    Both sides are limited to a few rows by a distributed top-k before they
    are gathered.
    """
    blocks = (
        active_blocks(blocked)
        .orderBy(F.desc_nulls_last("blocked_at"), "ip")
        .limit(CONTEXT_ITEMS)
        .select(
            F.struct(
                (-F.unix_micros("blocked_at")).alias("k"),
                "ip",
                F.format_string(
                    BLOCK_LINE,
                    "ip",
                    zoned_text(F.col("blocked_at"), zone, CONTEXT_TIME),
                    "reason",
                ).alias("line"),
            ).alias("item")
        )
    )
    newest = (
        alerts.orderBy(F.desc("timestamp"), *tie_break)
        .limit(CONTEXT_ITEMS)
        .select(
            F.struct(
                (-F.col("timestamp")).alias("k"),
                *tie_break,
                F.format_string(ALERT_LINE, "message", "status", "severity").alias("line"),
            ).alias("item")
        )
    )

    def listing(rows, none_line):
        ordered = F.array_sort(F.collect_list("item"))
        text = F.array_join(F.transform(ordered, lambda item: item["line"]), "")
        return rows.agg(F.when(text == "", none_line).otherwise(text).alias("text"))

    return listing(blocks, NO_BLOCKS).select(
        F.concat(
            F.lit(CONTEXT_HEAD + BLOCKS_HEAD),
            F.col("text"),
            F.lit(ALERTS_HEAD),
            listing(newest, NO_ALERTS).scalar(),
        ).alias("context")
    )


def build_prompts(routed, col, context):
    """Final prompt per routed question; ``context`` is the one-row context.

    The context is read as a scalar subquery, so no join takes place.
    """
    question = F.col(col)
    full = F.concat(
        F.lit(CONTEXT_PROMPT),
        context.select("context").scalar(),
        F.lit(QUESTION_PROMPT),
        question,
    )
    return routed.withColumn(
        "prompt",
        F.when(F.col("is_generic"), F.concat(F.lit(GENERIC_PROMPT), question)).otherwise(full),
    )


def build_sql_prompts(df, col):
    """Prompt asking for one SQL query per request in ``col``."""
    before, after = SQL_PROMPT
    return df.withColumn("prompt", F.concat(F.lit(before), F.col(col), F.lit(after)))


def _reasoning(text):
    return F.regexp_extract(text, REASONING, 1)


def _answer(text):
    return F.regexp_replace(text, REASONING, "")


def split_reasoning(df, col):
    """Add ``reasoning`` (the first block) and ``answer`` (without any block).

    A block that is never closed takes the rest of the text.
    """
    return df.withColumn("reasoning", _reasoning(F.col(col))).withColumn(
        "answer", _answer(F.col(col))
    )


def assemble_chunks(chunks, key, seq, block=1000):
    """Final answer and reasoning per reply from its streamed chunks.

    ``chunks`` has ``response`` and ``thinking`` per row; ``seq`` is a
    non-negative integer, unique within ``key``. A chunk with reasoning adds
    its response straight to the answer; a later plain chunk rewrites the
    answer from all plain text so far, so only what follows the last plain
    chunk is kept beside it. Reasoning follows the same rule once the plain
    text holds a reasoning block.

    Chunks are first joined per run of ``block`` sequence numbers, in parallel
    even for a single huge reply; only one row per run meets its reply.
    """
    thinks = F.coalesce("thinking", F.lit("")) != ""
    chunk = F.struct(
        F.col(seq).alias("seq"),
        F.coalesce("response", F.lit("")).alias("response"),
        F.coalesce("thinking", F.lit("")).alias("thinking"),
        thinks.alias("thinks"),
    )

    def joined(items, field):
        return F.array_join(F.transform(items, lambda item: item[field]), "")

    runs = (
        chunks.groupBy(key, F.floor(F.col(seq) / block).alias("run"))
        .agg(F.array_sort(F.collect_list(chunk)).alias("items"))
        .withColumn("plain", F.filter("items", lambda item: ~item["thinks"]))
        .withColumn("last_plain", F.try_element_at(F.col("plain.seq"), F.lit(-1)))
        .withColumn(
            "tail",
            F.filter(
                "items",
                lambda item: item["thinks"]
                & (item["seq"] > F.coalesce(F.col("last_plain"), F.lit(-1))),
            ),
        )
        .select(
            key,
            F.struct(
                "run",
                (F.size("plain") > 0).alias("has_plain"),
                joined(F.col("plain"), "response").alias("raw"),
                joined(F.col("items"), "thinking").alias("thinking"),
                joined(F.col("tail"), "response").alias("tail_response"),
                joined(F.col("tail"), "thinking").alias("tail_thinking"),
            ).alias("part"),
        )
    )
    replies = (
        runs.groupBy(key)
        .agg(F.array_sort(F.collect_list("part")).alias("parts"))
        .withColumn("plain", F.filter("parts", lambda part: part["has_plain"]))
        .withColumn("last_plain", F.try_element_at(F.col("plain.run"), F.lit(-1)))
        .withColumn(
            "tail",
            F.filter(
                "parts",
                lambda part: part["run"] >= F.coalesce(F.col("last_plain"), F.lit(0)),
            ),
        )
        .select(
            key,
            joined(F.col("parts"), "raw").alias("raw"),
            joined(F.col("parts"), "thinking").alias("thinking"),
            joined(F.col("tail"), "tail_response").alias("tail_response"),
            joined(F.col("tail"), "tail_thinking").alias("tail_thinking"),
        )
    )
    marked = F.contains("raw", F.lit(REASONING_MARK))
    return replies.select(
        key,
        F.concat(_answer(F.col("raw")), F.col("tail_response")).alias("answer"),
        F.when(marked, F.concat(_reasoning(F.col("raw")), F.col("tail_thinking")))
        .otherwise(F.col("thinking"))
        .alias("reasoning"),
    )
