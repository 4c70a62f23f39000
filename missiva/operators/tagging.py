"""Tags from an outside service, through an injected client; nothing here holds credentials."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from missiva.operators.archive import parse_llm_reply

PROMPT = "Give the topic, subtopic, up to five tags, a confidence from 0 to 1 and a one-line summary of this message as JSON.\nSubject: {subject}\n\n{body}"


def tag(mail: DataFrame, make_client: Callable[[], Callable[[str], str]], key: str = "ingest_seq", body_chars: int = 6000, tries: int = 3) -> DataFrame:
    """Add ``llm_topic, llm_subtopic, llm_tags, llm_confidence, llm_summary`` from a client's JSON replies.

    make_client runs once in each task and returns a function from prompt to reply. A call that
    fails ``tries`` times leaves an empty reply, which parses to the topic ``unknown``.
    """

    def run(batches):
        client = make_client()
        for pdf in batches:
            replies = []
            for subject, body in zip(pdf["subject"], pdf["body"]):
                reply = ""
                for _ in range(tries):
                    try:
                        reply = client(PROMPT.format(subject=subject or "", body=(body or "")[:body_chars]))
                        break
                    except Exception:
                        continue
                replies.append(reply)
            yield pdf[["_k"]].assign(reply=replies)

    asked = mail.select(F.col(key).cast("string").alias("_k"), F.col("subject"), F.coalesce(F.nullif(F.col("clean_body"), F.lit("")), F.col("body")).alias("body"))
    replies = asked.mapInPandas(run, "_k string, reply string").select("_k", parse_llm_reply(F.col("reply")).alias("_r"))
    kept = [c for c in mail.columns if not c.startswith("llm_")]
    return mail.select(*kept, F.col(key).cast("string").alias("_k")).join(replies, "_k").select(
        *kept, F.coalesce("_r.topic", F.lit("unknown")).alias("llm_topic"), F.coalesce("_r.subtopic", F.lit("")).alias("llm_subtopic"), F.coalesce(F.array_join("_r.tags", "; "), F.lit("")).alias("llm_tags"), F.col("_r.confidence").alias("llm_confidence"), F.coalesce("_r.summary", F.lit("")).alias("llm_summary")
    )
