"""Conversations as one formatted string each, with column functions only.

A turn's content is a list of typed parts. A visitor flattens them in order: neighbouring
texts become one text, which is escaped as a whole and kept, an image, an audio clip or a document becomes a numbered
placeholder, whose reference and expanded token count go to a side list.

    <|turn|>role<|body|>content<|end|>\\n        once per turn

Control strings inside texts and roles are escaped by one backslash after their
first character; text that already looks escaped gets one more, so that taking one
away gives back every text.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>\n"
# Control strings of common chat templates, without their first character (< or [).
REST = r"(?:\|[A-Za-z0-9_:]*\|>|/?s>|/?SYS>>|/?INST\])"
FIRST = r"[<\[]"
MEDIA = ("image", "audio", "document")
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"


def escape(text: Column) -> Column:
    """The text with a backslash put into every control string."""
    return F.regexp_replace(text, rf"({FIRST})(\\*)(?={REST})", r"$1\\$2")


def unescape(text: Column) -> Column:
    """What `escape` was given."""
    return F.regexp_replace(text, rf"({FIRST})\\(\\*)(?={REST})", "$1$2")


def text_part(text: Column) -> Column:
    """A content of one text part; null is empty."""
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text")).cast("struct<kind:string,text:string>"))


def _full(parts: Column, given: set[str]) -> Column:
    """Parts with all fields of PART."""
    fields = [f.split(":") for f in PART[len("struct<"):-1].split(",")]
    return F.transform(parts, lambda p: F.struct(*[
        (p.getField(n) if n in given else F.lit(None)).cast(t).alias(n) for n, t in fields]))


def expanded(part: Column, patch: int, rate: float, per_page: int) -> Column:
    """Tokens that a placeholder stands for; missing measures count as 0."""
    def whole(c):
        return F.coalesce(F.ceil(c).cast("long"), F.lit(0))

    return (F.when(part["kind"] == "image", whole(part["width"] / patch) * whole(part["height"] / patch))
            .when(part["kind"] == "audio", whole(part["seconds"] * rate))
            .when(part["kind"] == "document", F.coalesce(part["pages"], F.lit(0)).cast("long") * per_page).otherwise(F.lit(0)))


def placeholder(part: Column, place: Column) -> Column:
    """`<|kind:place|>`; a kind that is not known is called other."""
    kind = F.when(part["kind"].isin(*MEDIA), part["kind"]).otherwise("other")
    return F.concat(F.lit("<|"), kind, F.lit(":"), place.cast("string"), F.lit("|>"))


def flattened(parts: Column) -> Column:
    """Content of a turn: texts escaped, what is between them as placeholders.

    The texts are joined, with a mark where another part stands, and cut at the marks again; a zero byte is the only character
    of marks, and those of the texts are told apart.
    """
    raw = F.array_join(F.transform(parts, lambda p: F.when(is_text(p), F.replace(F.coalesce(p["text"], F.lit("")), F.lit("\0"), F.lit("\0t")))
                                   .otherwise(F.lit("\0m"))), "")
    runs = F.transform(F.split(raw, "\0m", -1), lambda r: escape(F.replace(r, F.lit("\0t"), F.lit("\0"))))
    others = F.filter(F.transform(parts, lambda p, i: F.when(~is_text(p), placeholder(p, i))), lambda o: o.isNotNull())
    return F.array_join(F.transform(runs, lambda r, i: F.concat(r, F.coalesce(F.get(others, i), F.lit("")))), "")


def is_text(part: Column) -> Column:
    """Whether a part is text; one without a kind is."""
    return F.coalesce(part["kind"], F.lit("text")) == "text"


def format_chats(turns: DataFrame, parts: str, conv: str = "conv_id", turn: str = "turn", role: str = "role", *,
                 patch: int = 14, rate: float = 25.0, per_page: int = 256, learn: str = "assistant") -> DataFrame:
    """One row per conversation: conv, n_turns, formatted, loss, attachments, expanded_tokens.

    `parts` names an array of structs with any of the fields of PART. loss lists (turn, start, length): characters of the
    turn's stretch of `formatted`, from its marker on, that are learned, which is the content of every `learn` turn.
    attachments lists (turn, part, kind, ref, tokens) in order; (turn, part) is where the placeholder stands.

    Turns are ordered by turn (null first), then role, then content. Null role, null text and null parts are empty. A null
    conversation id is a conversation. Repeated rows are turns of their own. No rows: no rows. A conversation is one
    string and must fit a row; rows are formatted before they are grouped. Other columns are not looked at.
    """
    given = {f.name for f in turns.schema[parts].dataType.elementType.fields}
    rows = turns.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
                        _full(F.coalesce(F.col(parts), F.array().cast(turns.schema[parts].dataType)), given).alias("parts"))
    media = F.filter(F.transform("parts", lambda p, i: F.struct(i.alias("part"), p["kind"].alias("kind"), p["ref"].alias("ref"),
                                                                 expanded(p, patch, rate, per_page).alias("tokens"))),
                     lambda a: F.coalesce(a["kind"], F.lit("text")) != "text")
    one = F.struct("turn", "role", flattened(F.col("parts")).alias("content"), media.alias("media"))
    chats = rows.select("conv_id", one.alias("one")).groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("all"))
    head = lambda t: F.concat(F.lit(TURN), escape(t["role"]), F.lit(BODY))
    formatted = F.array_join(F.transform("all", lambda t: F.concat(head(t), t["content"], F.lit(END))), "")
    loss = F.filter(F.transform("all", lambda t, i: F.struct(i.alias("turn"), F.length(head(t)).alias("start"), F.length(t["content"]).alias("length"), t["role"].alias("role"))),
                    lambda s: s["role"] == learn)
    listed = F.flatten(F.transform("all", lambda t, i: F.transform(t["media"], lambda a: F.struct(
        i.alias("turn"), a["part"].alias("part"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens")))))
    return chats.select(
        "conv_id", F.size("all").cast("long").alias("n_turns"), formatted.alias("formatted"),
        F.transform(loss, lambda s: F.struct(s["turn"].alias("turn"), s["start"].alias("start"), s["length"].alias("length"))).alias("loss"),
        listed.alias("attachments"),
    ).withColumn("expanded_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]))


def read_back(chats: DataFrame) -> DataFrame:
    """Add turns (array of role and content) and learned (the text under the loss mask), both unescaped, from the formatted strings."""
    pieces = F.filter(F.split("formatted", r"<\|turn\|>"), lambda s, i: i > 0)  # nothing stands before the first marker
    cut = chats.withColumn("stretches", F.transform(pieces, lambda s: F.concat(F.lit(TURN), s)))
    inner = lambda s: F.substr(s, F.lit(len(TURN) + 1), F.length(s) - len(TURN) - len(END))
    turns = F.transform("stretches", lambda s: F.struct(
        unescape(F.substring_index(inner(s), BODY, 1)).alias("role"),
        unescape(F.substr(inner(s), F.length(F.substring_index(inner(s), BODY, 1)) + len(BODY) + 1)).alias("content")))
    learned = F.array_join(F.transform("loss", lambda m: unescape(F.substr(F.get("stretches", m["turn"]), m["start"] + 1, m["length"]))), "")
    return cut.withColumns({"turns": turns, "learned": learned}).drop("stretches")


def op5_query(spark, sf_dir: str) -> DataFrame:
    """All conversations and one made of control strings, formatted, and read back."""
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    made = spark.range(2).select(F.lit(-1).cast("long"), "id", F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(hard))
    back = read_back(format_chats(given.union(made).withColumn("parts", text_part(F.col("text"))), "parts"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["content"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
                       F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


OP5_SQL = rf"""
WITH f_turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
f_sizes AS (
  SELECT *, length(role) + length(text) + {len(TURN) + len(BODY) + len(END)}
         + len(regexp_extract_all(role, '{FIRST}\\*{REST}')) + len(regexp_extract_all(text, '{FIRST}\\*{REST}')) AS chars
  FROM f_turns)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM f_sizes GROUP BY conv_id"""
