"""The same results in DuckDB SQL, written from the rules and not from the Spark plans."""

from __future__ import annotations

import sys

from chatlake.operators import style

WHITE_SPACE = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())
PLACEHOLDER = chr(0xFFFC)
NBSP, WIDE_SPACE, SMILE = chr(0xA0), chr(0x3000), chr(0x1F600)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _stripped(column: str) -> str:
    return f"trim(replace({column}, {_quoted(PLACEHOLDER)}, ''), {_quoted(WHITE_SPACE)})"


def _clock(date: str) -> str:
    return (
        f"strftime(make_timestamp(({date} // 1000000000 + 978307200) * 1000000), "
        "'%Y-%m-%d %H:%M:%S')"
    )


_REACTION = r"'^(Liked|Loved|Laughed at|Emphasized|Disliked|Questioned|Reacted)'"


def _cleaned(column: str) -> str:
    return (
        f"CASE WHEN coalesce({column}, '') = '' THEN '' "
        f"WHEN regexp_matches({column}, {_REACTION}) THEN '' "
        f"WHEN regexp_matches(lower({column}), '(emphasized|reacted with)') THEN '' "
        f"ELSE {_stripped(column)} END"
    )


SOURCE = f"""
WITH turns AS (
  SELECT conv_id::BIGINT AS c, turn::BIGINT AS k, role, text AS said,
         (conv_id::BIGINT * 13 + turn::BIGINT * 7) % 20 AS h
  FROM conversations
),
message AS (
  SELECT c * 8 + k + 1 AS row_id,
    CASE h
      WHEN 0 THEN 'Liked “' || said || '”'
      WHEN 1 THEN {_quoted(PLACEHOLDER + ' ')} || said
      WHEN 2 THEN NULL
      WHEN 3 THEN NULL
      WHEN 4 THEN {_quoted(PLACEHOLDER)}
      WHEN 5 THEN said || {_quoted(' ' + SMILE)}
      WHEN 6 THEN 'They reacted with ' || said
      WHEN 7 THEN {_quoted(NBSP)} || said || {_quoted(WIDE_SPACE)}
      ELSE said END AS text,
    CASE WHEN h IN (2, 3)
      THEN encode('bplist00ZNSString$V"' || said || '"') END AS body,
    (725760000 + c * 5400 + k * 45) * 1000000000 AS date,
    CASE WHEN role = 'assistant' THEN 1 ELSE 0 END AS is_from_me,
    CASE WHEN role = 'assistant' THEN 0
      WHEN c % 30 < 20 THEN c + 1
      ELSE -(c + 1) END AS handle_id,
    CASE WHEN h IN (1, 3, 4) THEN 1 ELSE 0 END AS attached,
    'cached' || (c % 5)::VARCHAR AS cached_room,
    CASE c % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' END AS service,
    CASE WHEN h = 8 THEN 1 ELSE 0 END AS is_emote,
    CASE WHEN role = 'system' THEN 1 ELSE 0 END AS is_system
  FROM turns
),
chat AS (
  SELECT DISTINCT c + 1 AS row_id,
    CASE c % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'room' || c::VARCHAR END AS room_name,
    CASE WHEN c % 3 <> 0 THEN 'Chat ' || c::VARCHAR END AS display_name
  FROM turns
),
link AS (SELECT c + 1 AS chat_id, c * 8 + k + 1 AS message_id FROM turns),
handle AS (SELECT c_custkey + 1 AS row_id, c_name AS id FROM customer),
payload AS (
  SELECT row_id, decode(body) AS s,
    substring(decode(body), instr(decode(body), 'NSString$V"') + 11) AS rest
  FROM message WHERE body IS NOT NULL
),
decoded AS (
  SELECT row_id, CASE WHEN contains(s, 'NSString') AND instr(rest, '"') > 1
    THEN substring(rest, 1, instr(rest, '"') - 1) END AS decoded
  FROM payload
),
resolved AS (
  SELECT m.row_id, coalesce(m.text, d.decoded) AS resolved
  FROM message m LEFT JOIN decoded d ON m.row_id = d.row_id
),
"""


def _extracted(name: str, link: str) -> str:
    return f"""
{name} AS (
  SELECT m.row_id AS message_id, l.chat_id, r.resolved AS text, {_clock('m.date')} AS timestamp,
    m.is_from_me, h.id AS contact_id, m.attached AS has_media, c.display_name AS chat_name,
    CASE WHEN coalesce(c.room_name, '') <> '' THEN c.room_name ELSE m.cached_room END AS room_name
  FROM message m
  JOIN {link} l ON l.message_id = m.row_id
  JOIN chat c ON c.row_id = l.chat_id
  LEFT JOIN handle h ON h.row_id = m.handle_id
  JOIN resolved r ON r.row_id = m.row_id
  WHERE (m.text IS NOT NULL OR (m.body IS NOT NULL AND m.attached = 0))
    AND m.is_system = 0 AND m.is_emote = 0
    AND r.resolved IS NOT NULL
    AND NOT regexp_matches(r.resolved, {_REACTION})
)"""


def _clean(name: str, where: str = "true") -> str:
    return f"""
{name} AS (
  SELECT message_id, chat_id, content AS text, timestamp, is_from_me, contact_id, has_media,
    'convo_' || chat_id::VARCHAR AS conversation_id,
    row_number() OVER (PARTITION BY chat_id ORDER BY timestamp, message_id) - 1 AS message_index
  FROM (SELECT *, {_cleaned('text')} AS content FROM extracted)
  WHERE content <> '' AND {where}
)"""


EXTRACTED = SOURCE + _extracted("extracted", "link")
CLEANED = EXTRACTED + "," + _clean("cleaned")

_SYSTEM = f"struct_pack(role := 'system', content := {_quoted(style.PLAIN_PROMPT)})"
_CHAT_MESSAGE = (
    "struct_pack(role := CASE WHEN is_from_me = 1 THEN 'assistant' ELSE 'user' END, "
    "content := text)"
)
_SIZES = """
sizes AS (SELECT conversation_id, count(*) AS n FROM cleaned GROUP BY conversation_id),
ranked AS (
  SELECT conversation_id,
    row_number() OVER (ORDER BY md5('42:' || conversation_id), conversation_id) AS place,
    count(*) OVER () AS eligible
  FROM sizes WHERE n >= 3
),
labelled AS (
  SELECT conversation_id,
    CASE WHEN place <= floor(eligible * 0.9::DOUBLE) THEN 'train' ELSE 'validation' END AS split
  FROM ranked
)"""

EXPORTED = SOURCE + f"""
linked AS (
  SELECT l.chat_id FROM link l JOIN chat c ON c.row_id = l.chat_id
  GROUP BY l.chat_id HAVING count(l.message_id) > 3
),
kept AS (
  SELECT l.chat_id, m.row_id AS message_id, m.date, {_clock('m.date')} AS timestamp,
    CASE WHEN m.is_from_me = 0 THEN 'friend' ELSE 'self' END AS role,
    {_stripped('m.text')} AS content,
    CASE WHEN m.is_from_me = 0 THEN h.id ELSE 'me' END AS contact_id,
    contains(m.text, {_quoted(PLACEHOLDER)}) AS has_media
  FROM message m JOIN link l ON l.message_id = m.row_id
  JOIN linked USING (chat_id)
  LEFT JOIN handle h ON h.row_id = m.handle_id
  WHERE coalesce(m.text, '') <> '' AND {_cleaned('m.text')} <> ''
),
counted AS (
  SELECT *, count(*) OVER (PARTITION BY chat_id) AS message_count,
    row_number() OVER (PARTITION BY chat_id ORDER BY date, message_id) - 1 AS message_index
  FROM kept
),
exported AS (SELECT * FROM counted WHERE message_count >= 5)
"""

_DOCUMENT_MESSAGE = (
    "struct_pack(role := role, content := content, timestamp := timestamp, "
    "contact_id := contact_id, has_media := has_media)"
)
_EXPORT_CHAT = (
    "struct_pack(role := CASE WHEN role = 'friend' THEN 'user' ELSE 'assistant' END, "
    "content := content)"
)


def _pairs(rows: str, system: str = _SYSTEM) -> str:
    return f"""
    SELECT chat_id, message_index - 1 AS message_index,
      to_json(struct_pack(messages :=
        [{system}]
        || CASE WHEN r2 = 'self' AND r3 = 'friend' THEN
             [struct_pack(role := 'user', content := c3),
              struct_pack(role := 'assistant', content := c2)]
           ELSE [] END
        || [struct_pack(role := 'user', content := c1),
            struct_pack(role := 'assistant', content := content)]
      ))::VARCHAR AS pair
    FROM (
      SELECT *,
        lag(role, 1) OVER w AS r1, lag(content, 1) OVER w AS c1,
        lag(role, 2) OVER w AS r2, lag(content, 2) OVER w AS c2,
        lag(role, 3) OVER w AS r3, lag(content, 3) OVER w AS c3
      FROM {rows}
      WINDOW w AS (PARTITION BY chat_id ORDER BY message_index)
    ) WHERE role = 'self' AND r1 = 'friend'"""


_STYLE = EXPORTED + """,
style AS (
  SELECT count(*) AS own_messages,
    coalesce(sum(length(content)), 0) / greatest(count(*), 1) AS mean_length,
    coalesce(sum(len(regexp_extract_all(content,
      '[\\x{1F000}-\\x{1F9FF}]|[\\x{2600}-\\x{26FF}]|[\\x{2700}-\\x{27BF}]'))), 0)
      / greatest(count(*), 1) AS emojis_per_message
  FROM exported WHERE role = 'self'
)"""
_PROMPT = (
    f"printf({_quoted(style.STYLE_TEMPLATE)}, printf('%.2f', emojis_per_message), "
    "printf('%.0f', mean_length))"
)
_PLAIN = SOURCE.rstrip().rstrip(",")
_NUMBERED_MESSAGES = "message_index, conversation_id, message_id, chat_id, text, timestamp, " \
    "is_from_me, contact_id, has_media"


def _runs(order: str) -> str:
    return f"""
    SELECT (sum(fresh) OVER (ORDER BY {order} ROWS UNBOUNDED PRECEDING) - 1)::BIGINT AS run_index, *
    FROM (
      SELECT *, message_id % 16 AS slot,
        CASE WHEN lag(chat_id) OVER (ORDER BY {order}) = chat_id THEN 0 ELSE 1 END AS fresh
      FROM extracted
    )"""


def _profile(select: str) -> str:
    return _PLAIN + select


ORACLE = {
    "extract_messages": EXTRACTED + "SELECT * FROM extracted",
    "extract_after_mark": EXTRACTED + "SELECT * FROM extracted WHERE message_id > 100",
    "decode_bodies": _PLAIN + "SELECT * FROM decoded WHERE decoded IS NOT NULL",
    "resolve_texts": _PLAIN + "SELECT * FROM resolved",
    "room_name_fallback": _PLAIN + """
      SELECT m.row_id, c.display_name AS chat_name,
        coalesce(nullif(c.room_name, ''), m.cached_room) AS room_name
      FROM message m JOIN link l ON l.message_id = m.row_id
      LEFT JOIN chat c ON c.row_id = l.chat_id""",
    "duplicate_key_check": SOURCE + """
      links AS (
        SELECT chat_id, message_id FROM link UNION ALL
        SELECT (chat_id + 1) // 2, message_id FROM link
        WHERE message_id % 25 = 0 AND (chat_id + 1) // 2 <> chat_id
      ),""" + _extracted("extracted", "links") + """
      SELECT message_id, count(*) AS copies FROM extracted
      GROUP BY message_id HAVING count(*) > 1""",
    "stored_key_check": EXTRACTED + "SELECT message_id FROM extracted WHERE message_id > 100",
    "latest_mark": """
      SELECT coalesce(max(conv_id::BIGINT * 8 + turn + 1), 0) AS last_id FROM conversations
      WHERE turn % 2 = 0
        AND conv_id = (SELECT max(conv_id) FROM conversations WHERE turn % 2 = 0)""",
    "latest_marks": """
      WITH t AS (SELECT *, CASE WHEN turn % 2 = 0 THEN 'extract' ELSE 'clean' END AS stage
                 FROM conversations),
      newest AS (SELECT stage, max(conv_id) AS conv_id FROM t GROUP BY stage)
      SELECT t.stage, max(t.conv_id::BIGINT * 8 + t.turn + 1) AS last_id
      FROM t JOIN newest n ON n.stage = t.stage AND n.conv_id = t.conv_id GROUP BY t.stage""",
    "decode_legacy_marks": _PLAIN + "SELECT row_id, row_id AS last_id FROM message",
    "clean_text_rows": _PLAIN + f"SELECT row_id, {_cleaned('text')} AS cleaned FROM message",
    "cleaned_messages": CLEANED + "SELECT * FROM cleaned",
    "cleaned_messages_hot_chats": CLEANED + "SELECT * FROM cleaned",
    "cleaned_after_mark": EXTRACTED + "," + _clean("cleaned", "message_id > 100")
    + "SELECT * FROM cleaned",
    "cleaned_in_two_batches": EXTRACTED + "," + _clean("early", "(message_id - 1) % 8 < 3") + ","
    + _clean("late", "(message_id - 1) % 8 >= 3") + f""",
      stored AS (SELECT chat_id, count(*) AS n FROM early GROUP BY chat_id)
      SELECT {_NUMBERED_MESSAGES} FROM early UNION ALL
      SELECT l.* REPLACE (l.message_index + coalesce(s.n, 0) AS message_index)
      FROM (SELECT {_NUMBERED_MESSAGES} FROM late) l LEFT JOIN stored s ON s.chat_id = l.chat_id""",
    "conversation_runs": EXTRACTED + f"""
      SELECT run_index, chat_id, count(*) AS message_count,
        min(timestamp) AS first_timestamp, max(timestamp) AS last_timestamp
      FROM ({_runs('timestamp, message_id')}) GROUP BY run_index, chat_id""",
    "conversation_runs_blocks": EXTRACTED + f"""
      SELECT run_index, chat_id, count(*) AS message_count,
        min(slot) AS first_slot, max(slot) AS last_slot
      FROM ({_runs('message_id % 16, message_id')}) GROUP BY run_index, chat_id""",
    "conversation_stats": CLEANED + """
      SELECT conversation_id, count(*) AS message_count,
        sum(CASE WHEN is_from_me = 1 THEN 1 ELSE 0 END)::BIGINT AS own_count,
        sum(CASE WHEN has_media = 1 THEN 1 ELSE 0 END)::BIGINT AS media_count
      FROM cleaned GROUP BY conversation_id""",
    "conversations": CLEANED + f"""
      SELECT conversation_id, 0 AS part,
        to_json(list({_CHAT_MESSAGE} ORDER BY message_index))::VARCHAR AS messages
      FROM cleaned GROUP BY conversation_id""",
    "training_examples": CLEANED + f"""
      SELECT conversation_id, to_json(struct_pack(id := conversation_id, messages :=
          [{_SYSTEM}] || list({_CHAT_MESSAGE} ORDER BY message_index)))::VARCHAR AS example
      FROM cleaned GROUP BY conversation_id HAVING count(*) >= 3""",
    "training_examples_in_parts": CLEANED + f""",
      parts AS (
        SELECT conversation_id, message_index // 3 AS part,
          list({_CHAT_MESSAGE} ORDER BY message_index) AS m
        FROM cleaned GROUP BY ALL
      ),
      long AS (SELECT conversation_id FROM cleaned GROUP BY ALL HAVING count(*) >= 3)
      SELECT conversation_id, part, CASE
        WHEN part = 0 THEN to_json(struct_pack(
          id := conversation_id, messages := [{_SYSTEM}] || m))::VARCHAR
        ELSE to_json(struct_pack(id := conversation_id, part := part, messages := m))::VARCHAR
        END AS example
      FROM parts JOIN long USING (conversation_id)""",
    "train_val_split": CLEANED + "," + _SIZES + "SELECT * FROM labelled",
    "split_sizes": CLEANED + "," + _SIZES
    + "SELECT split, count(*) AS examples FROM labelled GROUP BY split",
    "dataset_metadata": CLEANED + "," + _SIZES + """
      SELECT (SELECT count(*) FROM sizes) AS num_conversations,
        count(*) AS num_examples,
        count(*) FILTER (split = 'train') AS num_training_examples,
        count(*) FILTER (split = 'validation') AS num_validation_examples
      FROM labelled""",
    "export_messages": EXPORTED + "SELECT * EXCLUDE (date) FROM exported",
    "export_messages_hot_chats": EXPORTED + "SELECT * EXCLUDE (date) FROM exported",
    "export_conversations": EXPORTED + f"""
      SELECT 'conversation_' || chat_id::VARCHAR AS id,
        coalesce(nullif(c.display_name, ''), 'Conversation-' || chat_id::VARCHAR) AS title,
        e.n AS message_count, e.m AS messages
      FROM (
        SELECT chat_id, count(*) AS n,
          to_json(list({_DOCUMENT_MESSAGE} ORDER BY message_index))::VARCHAR AS m
        FROM exported GROUP BY chat_id
      ) e JOIN chat c ON c.row_id = e.chat_id""",
    "export_sizes": EXPORTED + """
      SELECT 'conversation_' || e.chat_id::VARCHAR AS id, any_value(e.message_count) AS message_count,
        any_value(n.linked_count) AS linked_count
      FROM exported e
      JOIN (SELECT chat_id, count(message_id) AS linked_count FROM link GROUP BY chat_id) n USING (chat_id)
      GROUP BY e.chat_id""",
    "full_conversations": EXPORTED + f"""
      SELECT 'conversation_' || chat_id::VARCHAR AS id,
        to_json(struct_pack(id := 'conversation_' || chat_id::VARCHAR, messages :=
          [{_SYSTEM}] || list({_EXPORT_CHAT} ORDER BY message_index)))::VARCHAR AS example
      FROM exported GROUP BY chat_id""",
    "normalize_roles": EXPORTED + f"""
      SELECT 'conversation_' || chat_id::VARCHAR AS id,
        to_json(list({_EXPORT_CHAT} ORDER BY message_index))::VARCHAR AS messages
      FROM exported GROUP BY chat_id""",
    "reply_pairs": EXPORTED + _pairs("exported"),
    "reply_pairs_blocks": EXPORTED + _pairs("exported"),
    "reply_pairs_cleaned": CLEANED + _pairs(
        "(SELECT *, text AS content, CASE WHEN is_from_me = 0 THEN 'friend' ELSE 'self' END "
        "AS role FROM cleaned)"
    ),
    "style_stats": _STYLE + """
      SELECT own_messages, round(mean_length, 6) AS mean_length,
        round(emojis_per_message, 6) AS emojis_per_message FROM style""",
    "prompt": _STYLE + f"SELECT {_PROMPT} AS prompt FROM style",
    "prompt_variants": _STYLE + "".join(
        f"{' UNION ALL' if number else ''} SELECT {number} AS variant, "
        f"{_PROMPT} || {_quoted(suffix)} AS prompt FROM style"
        for number, suffix in enumerate(("", *style.VARIANT_SUFFIXES))
    ),
    "basic_counts": _profile("""
      SELECT 'Total messages' AS label, count(*) AS n FROM message UNION ALL
      SELECT 'Total conversations', count(*) FROM chat UNION ALL
      SELECT 'Total contacts', count(*) FROM handle UNION ALL
      SELECT 'Messages with attachments', count(*) FROM message WHERE attached = 1 UNION ALL
      SELECT 'Empty messages', count(*) FROM message WHERE text IS NULL OR text = ''"""),
    "by_service": _profile("""
      SELECT coalesce(nullif(service, ''), 'Unknown') AS service, n
      FROM (SELECT service, count(*) AS n FROM message GROUP BY service)"""),
    "time_range": _profile(f"""
      SELECT {_clock('min(date)')} AS first_message, {_clock('max(date)')} AS last_message
      FROM message WHERE date > 0"""),
    "length_stats": _profile("""
      SELECT round(avg(length(text)), 6) AS avg_length, min(length(text)) AS min_length,
        max(length(text)) AS max_length, count(*) AS count_with_text
      FROM message WHERE text IS NOT NULL AND length(text) > 0"""),
    "by_month": _profile(f"""
      SELECT substring({_clock('date')}, 1, 7) AS month, count(*) AS n
      FROM message WHERE date > 0 GROUP BY month"""),
    "by_hour": _profile(f"""
      SELECT substring({_clock('date')}, 12, 2) AS hour, count(*) AS n
      FROM message WHERE date > 0 GROUP BY hour"""),
    "top_senders": _profile("""
      SELECT CASE WHEN m.is_from_me = 1 THEN 'Me' ELSE coalesce(h.id, 'Unknown') END AS sender,
        count(*) AS n
      FROM message m LEFT JOIN handle h ON h.row_id = m.handle_id
      GROUP BY sender ORDER BY n DESC, sender LIMIT 10"""),
    "top_conversations": _profile("""
      SELECT c.row_id AS chat_id, coalesce(nullif(any_value(c.display_name), ''), 'Unnamed Chat')
        AS title, count(l.message_id) AS message_count
      FROM chat c JOIN link l ON l.chat_id = c.row_id
      GROUP BY c.row_id ORDER BY message_count DESC, c.row_id LIMIT 10"""),
    "oldest_conversation": _profile(f"""
      SELECT c.row_id AS chat_id, coalesce(nullif(any_value(c.display_name), ''), 'Unnamed Chat')
        AS title, {_clock('min(m.date)')} AS first_message, count(*) AS message_count
      FROM chat c JOIN link l ON l.chat_id = c.row_id JOIN message m ON m.row_id = l.message_id
      GROUP BY c.row_id ORDER BY first_message NULLS FIRST, c.row_id LIMIT 1"""),
    "recent_messages": _profile(f"""
      SELECT m.row_id AS message_id, {_clock('m.date')} AS sent_at,
        CASE WHEN m.is_from_me = 1 THEN 'Me' ELSE coalesce(h.id, 'Unknown') END AS sender,
        substring(m.text, 1, 50) || CASE WHEN length(m.text) >= 50 THEN '...' ELSE '' END
          AS text_sample
      FROM message m LEFT JOIN handle h ON h.row_id = m.handle_id
      WHERE m.text IS NOT NULL ORDER BY m.date DESC, m.row_id DESC LIMIT 5"""),
    "length_histogram": SOURCE + """
      lengths AS (SELECT length(text) AS x FROM message WHERE length(text) BETWEEN 1 AND 999),
      span AS (SELECT min(x) AS lo, max(x) AS hi FROM lengths),
      binned AS (
        SELECT CASE WHEN hi = lo THEN 0
          ELSE least(floor((x - lo)::DOUBLE / (hi - lo) * 30)::BIGINT, 29) END AS bin
        FROM lengths, span
      )
      SELECT r.range AS bin, round(lo + r.range * (hi - lo)::DOUBLE / 30, 6) AS lower_edge,
        coalesce(b.n, 0) AS n
      FROM range(30) r CROSS JOIN span
      LEFT JOIN (SELECT bin, count(*) AS n FROM binned GROUP BY bin) b ON b.bin = r.range""",
}

# What the jobs write is what the operators give.
ORACLE["prepared_examples"] = (
    f"SELECT e.conversation_id, s.split, e.example FROM ({ORACLE['training_examples']}) e "
    f"JOIN ({ORACLE['train_val_split']}) s USING (conversation_id)"
)
ORACLE["prepared_examples_in_parts"] = (
    f"SELECT e.conversation_id, e.part, s.split, e.example FROM ({ORACLE['training_examples_in_parts']}) e "
    f"JOIN ({ORACLE['train_val_split']}) s USING (conversation_id)"
)
ORACLE["exported_documents"] = ORACLE["export_conversations"]
ORACLE["exported_documents_in_parts"] = (
    "SELECT *, least(message_count, 3)::INTEGER AS longest_line, ceil(message_count / 3)::BIGINT AS line_count "
    f"FROM ({ORACLE['export_conversations']})"
)
ORACLE["stored_messages_two_runs"] = ORACLE["extract_messages"]
ORACLE["stored_cleaned_two_runs"] = ORACLE["cleaned_messages"]

_HALF = "(SELECT coalesce(max(row_id) // 2, 0) FROM message)"
_RESTARTING = (
    EXTRACTED + "," + _clean("early", f"message_id <= {_HALF}") + ","
    + _clean("late", f"message_id > {_HALF}") + f""",
      cleaned AS (
        SELECT {_NUMBERED_MESSAGES} FROM early UNION ALL SELECT {_NUMBERED_MESSAGES} FROM late
      )"""
)
ORACLE["stored_cleaned_restarting"] = _RESTARTING + "SELECT * FROM cleaned"
ORACLE["training_examples_two_batches"] = _RESTARTING + f"""
      SELECT conversation_id, to_json(struct_pack(id := conversation_id, messages :=
          [{_SYSTEM}] || list({_CHAT_MESSAGE} ORDER BY message_index, message_id)))::VARCHAR AS example
      FROM cleaned GROUP BY conversation_id HAVING count(*) >= 3"""
ORACLE["reply_pairs_two_batches"] = ORACLE["reply_pairs_cleaned"]
# Candidates are extracted rows before the text rules, which the mark counts too.
ORACLE["job_results"] = CLEANED + f""",
      candidates AS (
        SELECT m.row_id FROM message m
        JOIN link l ON l.message_id = m.row_id JOIN chat c ON c.row_id = l.chat_id
        WHERE (m.text IS NOT NULL OR (m.body IS NOT NULL AND m.attached = 0))
          AND m.is_system = 0 AND m.is_emote = 0
      ),
      n AS (
        SELECT (SELECT count(*) FROM extracted) AS e, (SELECT count(*) FROM cleaned) AS c,
          (SELECT count(*) FROM extracted WHERE message_id <= {_HALF}) AS e1,
          (SELECT count(*) FROM cleaned WHERE message_id <= {_HALF}) AS c1,
          (SELECT max(row_id) FROM candidates) AS em, (SELECT max(message_id) FROM cleaned) AS cm
      )
      SELECT '00 extracted' AS step, e1::BIGINT AS result FROM n
      UNION ALL SELECT '01 cleaned', c1 FROM n
      UNION ALL SELECT '02 extracted', e - e1 FROM n
      UNION ALL SELECT '03 cleaned', c - c1 FROM n
      UNION ALL SELECT '04 extracted', 0
      UNION ALL SELECT '05 cleaned', 0
      UNION ALL SELECT '06 extract_mark', em FROM n
      UNION ALL SELECT '07 clean_mark', cm FROM n
      UNION ALL SELECT '08 processed_at', e FROM n
      UNION ALL SELECT '09 cleaned_at', c FROM n
      UNION ALL SELECT '10 extracted_kept', e FROM n
      UNION ALL SELECT '11 cleaned_kept', 0
      UNION ALL SELECT '12 extracted_anew', e FROM n
      UNION ALL SELECT '13 cleaned_anew', c FROM n"""
ORACLE["imported_marks"] = ORACLE["latest_marks"]
ORACLE["written_metadata"] = ORACLE["dataset_metadata"]
ORACLE["written_prompts"] = ORACLE["prompt_variants"]


def _report_rows(name: str, query: str, *columns: str) -> str:
    values = [f"{c}::VARCHAR" for c in columns] + ["NULL::VARCHAR"] * (4 - len(columns))
    shown = ", ".join(f"{value} AS value_{at}" for at, value in enumerate(values, 1))
    return f"SELECT '{name}' AS report, {shown} FROM ({ORACLE[query]})"


ORACLE["profile_in_one_scan"] = " UNION ALL ".join(
    [
        _report_rows("basic_counts", "basic_counts", "label", "n"),
        _report_rows("count_by_service", "by_service", "service", "n"),
        _report_rows("time_range", "time_range", "first_message", "last_message"),
        _report_rows("length_stats", "length_stats", "avg_length", "min_length", "max_length", "count_with_text"),
        _report_rows("messages_by_month", "by_month", "month", "n"),
        _report_rows("messages_by_hour", "by_hour", "hour", "n"),
        _report_rows("top_senders", "top_senders", "sender", "n"),
        _report_rows("top_conversations", "top_conversations", "chat_id", "title", "message_count"),
        _report_rows("oldest_conversation", "oldest_conversation", "chat_id", "title", "first_message", "message_count"),
        _report_rows("recent_messages", "recent_messages", "message_id", "sent_at", "sender", "text_sample"),
        _report_rows("length_histogram", "length_histogram", "bin", "lower_edge", "n"),
    ]
)
ORACLE["snapshot_read"] = ORACLE["extract_messages"]

_COLUMNS = {
    "message": (
        "row_id bigint, text string, attributedBody binary, date bigint, is_from_me int, handle_id bigint, "
        "cache_has_attachments int, cache_roomnames string, service string, is_emote int, is_system_message int"
    ),
    "chat": "row_id bigint, room_name string, display_name string",
    "handle": "row_id bigint, id string",
    "chat_message_join": "chat_id bigint, message_id bigint",
}
_LISTED = ", ".join(
    f"('{table}', '{name}', '{kind}')"
    for table, columns in _COLUMNS.items()
    for name, kind in (column.split() for column in columns.split(", "))
)
ORACLE["source_tables"] = SOURCE + f"""
  listed (table_name, column_name, data_type) AS (VALUES {_LISTED}),
  sizes AS (
    SELECT 'message' AS table_name, count(*) AS row_count FROM message UNION ALL
    SELECT 'chat', count(*) FROM chat UNION ALL
    SELECT 'handle', count(*) FROM handle UNION ALL
    SELECT 'chat_message_join', count(*) FROM link
  )
  SELECT table_name, column_name, data_type, row_count FROM listed JOIN sizes USING (table_name)"""

_STYLED = _STYLE + f", rendered AS (SELECT {_PROMPT} AS prompt FROM style) "
_STYLED_SYSTEM = "struct_pack(role := 'system', content := prompt)"
ORACLE["written_conversations"] = _STYLED + f"""
  SELECT 'conversation_' || chat_id::VARCHAR AS id,
    to_json(struct_pack(id := 'conversation_' || chat_id::VARCHAR, messages :=
      [any_value({_STYLED_SYSTEM})] || list({_EXPORT_CHAT} ORDER BY message_index)))::VARCHAR AS example
  FROM exported CROSS JOIN rendered GROUP BY chat_id"""
ORACLE["written_pairs"] = _STYLED + (
    f"SELECT pair FROM ({_pairs('(SELECT * FROM exported CROSS JOIN rendered)', _STYLED_SYSTEM)})"
)
ORACLE["stored_id_order"] = EXTRACTED + "SELECT count(*) AS messages, 0 AS out_of_order FROM extracted"
ORACLE["streamed_messages"] = ORACLE["extract_messages"]
