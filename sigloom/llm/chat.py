"""Chat formatting in Spark expressions: collect, sort, merge adjacent same-role turns, concatenate.

A conversation becomes one string:

    <|turn|>ROLE<|text|>TEXT<|part|>TEXT<|end|>\\n ...

Turns of one role in a row form one block, whose texts stay apart by ``<|part|>``.
Every control string starts with ``<|``. Inside roles and texts a backslash is
doubled and ``<|`` becomes ``<\\|``, so no text can hold a control string, and
dropping each escaping backslash gives the text back.

``segments`` holds the same string in pieces with the loss mask: true on the texts
of assistant turns, false on control strings and on everything else.

Defined results: rows are sorted by turn (null first), then role, then text, so
ties and repeated rows have one order and all stay; a null role or text counts as
empty; rows with a null conv_id form one conversation; an empty table gives an
empty result; other columns are ignored. A conversation is one output row, so it
has to fit into one, whatever the method.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TURN, TEXT, PART, END = "<|turn|>", "<|text|>", "<|part|>", "<|end|>\n"


def _escaped(x: str) -> str:
    return f"replace(replace({x}, '\\\\', '\\\\\\\\'), '<|', '<\\\\|')"


def _plain(x: str) -> str:
    return f"regexp_replace({x}, '(?s)\\\\\\\\(.)', '$1')"


def format_conversations(conversations: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, messages, segments, formatted.

    messages: array of (role, texts) after merging; segments: array of (text, loss);
    formatted: the concatenation of the segments.
    """
    turns = conversations.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    sorted_turns = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    starts = sorted_turns.withColumn("starts", F.expr("filter(sequence(0, size(turns) - 1), i -> i = 0 or turns[i].role <> turns[i - 1].role)"))
    messages = starts.select(
        "conv_id",
        F.expr(
            """transform(starts, (s, k) -> named_struct(
                 'role', turns[s].role,
                 'texts', transform(slice(turns, s + 1, coalesce(get(starts, k + 1), size(turns)) - s), t -> t.text)))"""
        ).alias("messages"),
    )
    segments = messages.withColumn(
        "segments",
        F.expr(
            f"""flatten(transform(messages, m -> concat(
                  array(named_struct('text', concat('{TURN}', {_escaped("m.role")}, '{TEXT}'), 'loss', false)),
                  flatten(transform(m.texts, (x, i) -> concat(
                    slice(array(named_struct('text', '{PART}', 'loss', false)), 1, if(i > 0, 1, 0)),
                    array(named_struct('text', {_escaped("x")}, 'loss', m.role = 'assistant'))))),
                  array(named_struct('text', '<|end|>\\n', 'loss', false)))))"""
        ),
    )
    return segments.withColumn("formatted", F.expr("array_join(transform(segments, s -> s.text), '')"))


def read_back(formatted: DataFrame) -> DataFrame:
    """What the formatted strings say: conv_id, turns (array of (role, text)), loss_text, and the string itself.

    Turns are parsed from ``formatted`` alone; loss_text is the unescaped text under the mask.
    """
    return formatted.select(
        "conv_id",
        F.expr(
            f"""flatten(transform(filter(split(formatted, '<\\\\|turn\\\\|>'), (b, i) -> i > 0), b ->
                  transform(split(regexp_replace(split(b, '<\\\\|text\\\\|>')[1], '<\\\\|end\\\\|>\\n$', ''), '<\\\\|part\\\\|>'), x ->
                    named_struct('role', {_plain("split(b, '<\\\\|text\\\\|>')[0]")}, 'text', {_plain("x")}))))"""
        ).alias("turns"),
        F.expr(f"array_join(transform(filter(segments, s -> s.loss), s -> {_plain('s.text')}), '')").alias("loss_text"),
        "formatted",
    )


def digests(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back from the output."""
    return read_back(formatted).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.expr("sha2(array_join(transform(turns, t -> concat(t.role, '\\n', t.text, '\\n')), ''), 256)").alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


#: The conversation that the query adds: texts that look like control strings.
TRICKY = (-7, "\\### Assistant: </turn> ok")


def with_tricky(conversations: DataFrame) -> DataFrame:
    text = TRICKY[1].replace("\\", "\\\\")
    extra = conversations.sparkSession.sql(
        f"select * from values (cast({TRICKY[0]} as bigint), cast(0 as bigint), 'user', '{text}'), "
        f"(cast({TRICKY[0]} as bigint), cast(1 as bigint), 'assistant', '{text}') as t(conv_id, turn, role, text)"
    )
    return conversations.select("conv_id", "turn", "role", "text").unionByName(extra)


ORACLE = r"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
), marked as (
  select *, lag(role) over w as before,
         length(replace(replace(text, '\', '\\'), '<|', '<\|')) as text_chars,
         length(replace(replace(role, '\', '\\'), '<|', '<\|')) as role_chars
  from rows window w as (partition by conv_id order by turn nulls first, role, text)
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
       cast(sum(text_chars + 8 + case when before is null or before <> role then role_chars + 16 else 0 end) as bigint) as formatted_chars
from marked group by conv_id
"""
