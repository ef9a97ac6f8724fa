"""Conversation-format fine-tuning tables (O-39, O-67..O-77).

Turns live in a table ``(conv_id, turn, from, value)``; a conversation is gathered into
one row (bounded by that conversation's size) and all rules are higher-order array
expressions (``transform``, ``forall``, ``array_join``, ``flatten``) - no Python.

Tokens are whitespace words and ids a hash of the word (``md5`` -> 24 bits -> vocab),
so Spark and the SQL oracle agree; a real subword tokeniser plugs in as an
``array<string>`` column (e.g. a pandas UDF) in place of :func:`tokens`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import text as T
from .ordered import row_number

PAD_ID = 1
VOCAB = 50000
ID_OFFSET = 4
DEFAULT_SYSTEM = "A chat between a curious human and an artificial intelligence assistant."
SIGNAL_ROLES = ("Human", "Assistant")
TEMPLATE_ROLES = ("USER", "ASSISTANT")


#: One-separator prompts: what opens the system text and the roles, and what ends a message.
ROUND_SYSTEM, ROUND_ROLES, ROUND_SEP = "<|im_start|>system\n", ("<|im_start|>user\n", "<|im_start|>assistant\n"), "<|im_end|>"


def gather_turns(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """One row per conversation with ``turns: array<struct<turn, from, value>>`` in order."""
    return turns.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("turn", "from", "value"))).alias("turns"))


# ------------------------------------------------------------------ O-67


def to_conversations(df: DataFrame, key: str, image: Column, label: str, question: str = K.OCR_QUESTION,
                     keep: Sequence[str] = ()) -> DataFrame:
    """O-67: ``(id, image, groundtruth)`` -> two-turn conversation document (plus ``keep``
    columns, e.g. the arm used to partition the output)."""
    conv = F.array(F.struct(F.lit("human").alias("from"), F.lit(question).alias("value")),
                   F.struct(F.lit("gpt").alias("from"), F.col(label).cast("string").alias("value")))
    return df.select(*keep, F.col(key).alias("id"), image.alias("image"), conv.alias("conversations"))


# ------------------------------------------------------------------ O-68 / O-69 / O-70


def map_role(c: Column, mode: str = "strict", roles: Sequence[str] = TEMPLATE_ROLES) -> Column:
    """O-68: human / gpt to template roles. strict: others null (rejected);
    signal: lower-cased test, others ``unknown``."""
    if mode == "signal":
        lc = F.lower(c)
        return F.when(lc == "human", F.lit(roles[0])).when(lc == "gpt", F.lit(roles[1])).otherwise(F.lit("unknown"))
    return F.when(c == "human", F.lit(roles[0])).when(c == "gpt", F.lit(roles[1]))


def prepare_turns(conv: DataFrame) -> DataFrame:
    """O-69 / O-70 on gathered turns.

    ``system``: value of a leading system turn (becomes the header), ``dialog``: turns
    after dropping one leading non-human turn, ``status``: ``ok``, ``empty`` (nothing
    left), ``bad_role`` (a role other than human / gpt) or ``bad_alternation``.
    """
    first = F.get(F.col("turns"), 0)
    lead_drop = first["from"] != "human"
    dialog = F.when(lead_drop, F.slice("turns", 2, F.greatest(F.size("turns") - 1, F.lit(0)))).otherwise(F.col("turns"))
    system = F.when(first["from"] == "system", first["value"])
    out = conv.withColumn("dialog", dialog).withColumn("system", system).withColumn("leading_dropped", lead_drop)
    bad_role = F.exists("dialog", lambda x: ~x["from"].isin("human", "gpt"))
    alternates = F.forall(F.transform("dialog", lambda x, i: x["from"] == F.when(i % 2 == 0, F.lit("human"))
                                      .otherwise(F.lit("gpt"))), lambda b: b)
    status = (F.when(F.size("dialog") == 0, F.lit("empty")).when(bad_role, F.lit("bad_role"))
              .when(~alternates, F.lit("bad_alternation")).otherwise(F.lit("ok")))
    return out.withColumn("status", status)


# ------------------------------------------------------------------ O-71 / O-72


def signal_header(system: Column) -> Column:
    return F.concat(F.coalesce(system, F.lit(DEFAULT_SYSTEM)), F.lit("\n\n"))


def signal_sentence(x: Column, roles: Sequence[str] = SIGNAL_ROLES) -> Column:
    return F.concat(F.lit(K.SIGNAL_BEGIN), map_role(x["from"], "signal", roles), F.lit(": "), x["value"],
                    F.lit(K.SIGNAL_END))


def render_signal(dialog: Column, header: Column, roles: Sequence[str] = SIGNAL_ROLES) -> Column:
    """O-71: header, then ``### Role: text\\n`` per turn, then a closing ``### ``."""
    return F.concat(header, F.array_join(F.transform(dialog, lambda x: signal_sentence(x, roles)), ""),
                    F.lit(K.SIGNAL_BEGIN))


def render_template(dialog: Column, system: Column, roles: Sequence[str] = TEMPLATE_ROLES, sep: str = " ",
                    sep2: str = "</s>") -> Column:
    """O-72: two-separator prompt: ``system + sep``, then ``Role: text`` + sep / sep2
    alternately (an empty message renders as ``Role:``)."""
    def one(x, i):
        role = map_role(x["from"], "strict", roles)
        closing = F.when(i % 2 == 0, F.lit(sep)).otherwise(F.lit(sep2))
        return F.when((x["value"].isNull()) | (x["value"] == ""), F.concat(role, F.lit(":"))).otherwise(
            F.concat(role, F.lit(": "), x["value"], closing))

    return F.concat(F.coalesce(system, F.lit(DEFAULT_SYSTEM)), F.lit(sep), F.array_join(F.transform(dialog, one), ""))


# ------------------------------------------------------------------ O-73 / O-74


def hoist_image_token(value: Column, mmtag: bool = False, im_start_end: bool = False) -> Column:
    """O-73: move the image token to the front followed by a newline, stripped; optional
    ``<Image>`` tag wrapping and start/end tokens."""
    tok = K.IMAGE_TOKEN
    moved = T.pystrip(F.concat(F.lit(tok + "\n"), T.pystrip(F.replace(value, F.lit(tok), F.lit("")))))
    if mmtag:
        moved = F.replace(moved, F.lit(tok), F.lit("<Image>" + tok + "</Image>"))
    out = F.when(value.contains(tok), moved).otherwise(value)
    if im_start_end:
        out = F.replace(out, F.lit(tok), F.lit(K.IMAGE_START_TOKEN + tok + K.IMAGE_END_TOKEN))
    return out


def plain_pair(dialog: Column, sep: str = "\n") -> Column:
    """O-74: struct(ok, text, masked_tokens): exactly two turns, the first holding the
    image token; text = token + answer + sep; the token part is masked."""
    ok = (F.size(dialog) == 2) & F.get(dialog, 0)["value"].contains(K.IMAGE_TOKEN)
    text = F.concat(F.lit(K.IMAGE_TOKEN), F.get(dialog, 1)["value"], F.lit(sep))
    return F.struct(ok.alias("ok"), F.when(ok, text).alias("text"),
                    F.when(ok, F.size(tokens(F.lit(K.IMAGE_TOKEN)))).alias("masked_tokens"))


def image_token_ids(text: Column, image_id: int = K.IMAGE_TOKEN_INDEX) -> Column:
    """Token ids of a text in which the image token is one token, also where it touches a word."""
    pieces = F.transform(F.split(text, _re_escape(K.IMAGE_TOKEN)), lambda x: token_ids(tokens(x)))
    mark = F.array(F.lit(image_id))
    return F.concat(F.get(pieces, 0), F.flatten(F.transform(F.slice(pieces, 2, F.size(pieces)), lambda p: F.concat(mark, p))))


def plain_pair_ids(dialog: Column, sep: str = "\n", first_tokens: int = 0, image_id: int = K.IMAGE_TOKEN_INDEX) -> Column:
    """O-74: struct(ok, input_ids, labels) of a plain pair: ids of token + answer + ``sep``, the
    image token (and ``first_tokens`` that a tokeniser puts before it) masked; null if not ok."""
    p = plain_pair(dialog, sep)
    ids = image_token_ids(p["text"], image_id)
    masked = 1 + first_tokens
    labels = F.concat(F.array_repeat(F.lit(K.IGNORE_INDEX), masked), F.slice(ids, masked + 1, F.size(ids)))
    return F.struct(p["ok"].alias("ok"), F.when(p["ok"], ids).alias("input_ids"), F.when(p["ok"], labels).alias("labels"))


# ------------------------------------------------------------------ tokens, O-75..O-77


def tokens(c: Column) -> Column:
    return T.words(c)


def token_ids(toks: Column, vocab: int = VOCAB, offset: int = ID_OFFSET) -> Column:
    """Hash ids: first 24 bits of md5(word) modulo ``vocab``, after ``offset`` specials."""
    return F.transform(toks, lambda t: (F.conv(F.substring(F.md5(t), 1, 6), 16, 10).cast("long") % vocab
                                        + offset).cast("int"))


def label_mask(dialog: Column, header: Column, max_length: int = 1024, roles: Sequence[str] = SIGNAL_ROLES,
               keep_head: int = 2) -> Column:
    """O-75 (signal format): struct(input_ids, labels).

    Header tokens masked; in each human sentence all but the first ``keep_head`` tokens
    (``###`` and the role) masked; answers kept; the closing ``###`` kept. Cut at
    ``max_length``.
    """
    head_ids = token_ids(tokens(header))
    per_turn = F.transform(dialog, lambda x: F.struct(x["from"].alias("f"), token_ids(tokens(signal_sentence(x, roles)))
                                                      .alias("ids")))
    closing = token_ids(tokens(F.lit(K.SIGNAL_BEGIN)))
    ids = F.concat(head_ids, F.flatten(F.transform(per_turn, lambda p: p["ids"])), closing)
    masked_turn = lambda p: F.when(
        p["f"] == "human",
        F.concat(F.slice(p["ids"], 1, keep_head),
                 F.array_repeat(F.lit(K.IGNORE_INDEX), F.greatest(F.size(p["ids"]) - keep_head, F.lit(0)))),
    ).otherwise(p["ids"])
    labels = F.concat(F.array_repeat(F.lit(K.IGNORE_INDEX), F.size(head_ids)),
                      F.flatten(F.transform(per_turn, masked_turn)), closing)
    return F.struct(F.slice(ids, 1, max_length).alias("input_ids"), F.slice(labels, 1, max_length).alias("labels"))


def template_tokens(prompt: Column, sep2: str = "</s>") -> Column:
    """Whitespace tokens of a template prompt with ``sep2`` as a token of its own."""
    return tokens(F.replace(prompt, F.lit(sep2), F.lit(f" {sep2} ")))


def label_mask_template(dialog: Column, system: Column, roles: Sequence[str] = TEMPLATE_ROLES, sep: str = " ",
                        sep2: str = "</s>", max_length: int = 1024, start: int = 0,
                        instruction_offset: int = 0) -> Column:
    """O-75 (two-separator template): struct(input_ids, labels).

    The prompt (O-72) is cut into rounds at ``sep2``; each round must split in exactly two
    at ``sep + roles[1] + ': '`` (else the walk stops, as does an empty round). In each
    round the instruction part (minus ``instruction_offset`` tokens) is masked; a round
    advances by its tokens plus the ``sep2`` token. Tokens before ``start`` and after the
    last complete round are masked, and if the walk does not end exactly at the token
    count (within ``max_length``) the whole row is masked. With whitespace tokens the
    offsets of a subword tokeniser (begin-of-text tokens) are 0.
    """
    prompt = render_template(dialog, system, roles, sep, sep2)
    toks = template_tokens(prompt, sep2)
    n = F.size(toks)
    ids = token_ids(toks)
    assist = sep + roles[1] + ": "
    rounds = F.split(prompt, _re_escape(sep2))

    def n_tok(x):
        return F.size(template_tokens(x, sep2))

    valid = F.transform(rounds, lambda r: (r != "") & (F.size(F.split(r, _re_escape(assist))) == 2))
    rlen = F.transform(rounds, lambda r: n_tok(r) + 1)
    ilen = F.transform(rounds, lambda r: n_tok(F.concat(F.get(F.split(r, _re_escape(assist)), 0), F.lit(assist)))
                       - instruction_offset)
    return _walk_labels(ids, rounds, valid, rlen, ilen, start, max_length)


def _walk_labels(ids: Column, rounds: Column, valid: Column, rlen: Column, ilen: Column, start: int, max_length: int) -> Column:
    """struct(input_ids, labels) of a walk over rounds: up to the first one that is not ``valid``, the
    first ``ilen`` of a round's ``rlen`` tokens are masked."""
    n = F.size(ids)
    first_bad = F.array_position(valid, False)
    k = F.when(first_bad == 0, F.size(rounds)).otherwise(first_bad - 1).cast("int")
    cur = F.lit(start) + F.aggregate(F.slice(rlen, 1, k), F.lit(0), lambda a, b: a + b)
    total = F.least(n, F.lit(max_length))
    all_masked = (cur < max_length) & (cur != total)
    # mask built from the round lengths (no per-token lambda): start, then per complete
    # round its instruction tokens masked and the rest kept, then everything after
    per_round = F.zip_with(rlen, ilen, lambda r, i: F.concat(
        F.array_repeat(F.lit(True), F.greatest(F.least(i, r), F.lit(0))),
        F.array_repeat(F.lit(False), F.greatest(r - F.greatest(i, F.lit(0)), F.lit(0)))))
    mask = F.concat(F.array_repeat(F.lit(True), F.lit(start)), F.flatten(F.slice(per_round, 1, k)),
                    F.array_repeat(F.lit(True), F.greatest(n - cur, F.lit(0))))
    kept = F.zip_with(ids, mask, lambda t, m: F.when(m | m.isNull(), F.lit(K.IGNORE_INDEX)).otherwise(t))
    labels = F.when(all_masked, F.array_repeat(F.lit(K.IGNORE_INDEX), n)).otherwise(kept)
    return F.struct(F.slice(ids, 1, max_length).alias("input_ids"), F.slice(labels, 1, max_length).alias("labels"))


def render_rounds(dialog: Column, system: Column, roles: Sequence[str] = ROUND_ROLES, sep: str = ROUND_SEP) -> Column:
    """One-separator prompt: the system text and every message end with ``sep``; a message is its
    role's opening and the text (an empty one the opening only, without ``sep``)."""
    def one(x):
        role = map_role(x["from"], "strict", roles)
        return F.when(x["value"].isNull() | (x["value"] == ""), role).otherwise(F.concat(role, x["value"], F.lit(sep)))

    return F.concat(F.lit(ROUND_SYSTEM), F.coalesce(system, F.lit(DEFAULT_SYSTEM)), F.lit(sep), F.array_join(F.transform(dialog, one), ""))


def label_mask_rounds(dialog: Column, system: Column, roles: Sequence[str] = ROUND_ROLES, sep: str = ROUND_SEP, max_length: int = 1024,
                      instruction_offset: int = 0, later_offset: int = 0) -> Column:
    """O-75 (one-separator prompt): struct(input_ids, labels).

    The prompt is cut at ``sep`` and put together again in rounds: system, first question and
    first answer are the first one, every further question and its answer another. A round must
    split in exactly two at ``sep + roles[1]``, else the walk stops, as does an empty one. Its part
    up to the answer (less ``instruction_offset`` tokens) is masked; it advances by its tokens,
    the separators inside it and the one after it. ``later_offset`` is added to both lengths of
    every round but the first (tokenisers that begin each piece with a token of their own).
    What follows the walk is masked, and all of it if the walk does not end at the token count.
    """
    prompt = render_rounds(dialog, system, roles, sep)
    ids = token_ids(template_tokens(prompt, sep))
    pieces = F.split(prompt, _re_escape(sep))
    later = F.when(F.size(pieces) > 3, F.transform(F.sequence(F.lit(4), F.greatest(F.size(pieces), F.lit(4)), F.lit(2)),
                                                   lambda i: F.array_join(F.slice(pieces, i, 2), sep))).otherwise(F.array().cast("array<string>"))
    rounds = F.concat(F.array(F.array_join(F.slice(pieces, 1, 3), sep)), later)
    answer = sep + roles[1]

    def n_tok(x):
        return F.size(template_tokens(x, sep))

    def extra(i):
        return F.when(i > 0, F.lit(later_offset)).otherwise(F.lit(0))

    valid = F.transform(rounds, lambda r: (r != "") & (F.size(F.split(r, _re_escape(answer))) == 2))
    rlen = F.transform(rounds, lambda r, i: n_tok(r) + 1 + extra(i))
    ilen = F.transform(rounds, lambda r, i: n_tok(F.concat(F.get(F.split(r, _re_escape(answer)), 0), F.lit(answer))) - instruction_offset + extra(i))
    return _walk_labels(ids, rounds, valid, rlen, ilen, 0, max_length)


def _re_escape(s: str) -> str:
    import re

    return re.escape(s)


def pad_to(arr: Column, length: int | Column, value: int) -> Column:
    n = F.size(arr)
    ln = F.lit(length) if isinstance(length, int) else length
    return F.concat(F.slice(arr, 1, ln), F.array_repeat(F.lit(value), F.greatest(ln - n, F.lit(0))))


def tokenise_pad(input_text: Column, target_text: Column, max_length: int = 1024, pad_id: int = PAD_ID) -> Column:
    """O-76: struct(input_ids, attention_mask, labels), truncated and padded to
    ``max_length``; labels are the padded target ids."""
    ii = token_ids(F.slice(tokens(input_text), 1, max_length))
    tt = token_ids(F.slice(tokens(target_text), 1, max_length))
    attn = pad_to(F.array_repeat(F.lit(1), F.size(ii)), max_length, 0)
    return F.struct(pad_to(ii, max_length, pad_id).alias("input_ids"), attn.alias("attention_mask"),
                    pad_to(tt, max_length, pad_id).alias("labels"), F.size(ii).alias("n_input"),
                    F.size(tt).alias("n_target"))


def token_ids_cut(text: Column, max_length: int = 1024) -> Column:
    """Ids of the first ``max_length`` tokens (tokens are cut before hashing)."""
    return token_ids(F.slice(tokens(text), 1, max_length))


def pad_ids(input_ids: Column, target_ids: Column, max_length: int = 1024, pad_id: int = PAD_ID) -> Column:
    """O-76 from id arrays: the same struct as :func:`tokenise_pad`. Lets a table be
    tokenised once per document and then fanned out to every arm that uses it."""
    ii = F.slice(input_ids, 1, max_length)
    tt = F.slice(target_ids, 1, max_length)
    attn = pad_to(F.array_repeat(F.lit(1), F.size(ii)), max_length, 0)
    return F.struct(pad_to(ii, max_length, pad_id).alias("input_ids"), attn.alias("attention_mask"),
                    pad_to(tt, max_length, pad_id).alias("labels"), F.size(ii).alias("n_input"),
                    F.size(tt).alias("n_target"))


def collate(df: DataFrame, order: Sequence[str], batch_size: int = 16, model_max: int = 1024,
            pad_id: int = PAD_ID, ids: str = "input_ids", labels: str = "labels") -> DataFrame:
    """O-77: batches of ``batch_size`` rows in ``order``; ids padded with ``pad_id`` and
    labels with the ignore value to the batch maximum, cut at ``model_max``;
    ``attention_mask`` = id != pad. The batch maximum is a window over one batch (at most
    ``batch_size`` rows); batch numbers come from a distributed row number."""
    r = row_number(df, order, name="_rn").withColumn("batch", F.floor((F.col("_rn") - 1) / batch_size).cast("long"))
    width = F.least(F.max(F.size(ids)).over(Window.partitionBy("batch")), F.lit(model_max))
    r = r.withColumn("_w", width)
    pid = pad_to(F.col(ids), F.col("_w"), pad_id)
    return (r.withColumn(ids, pid).withColumn(labels, pad_to(F.col(labels), F.col("_w"), K.IGNORE_INDEX))
            .withColumn("attention_mask", F.transform(ids, lambda x: x != pad_id))
            .withColumn("padded_len", F.col("_w").cast("long")).drop("_rn", "_w"))


# ------------------------------------------------------------------ O-39


def conversation_lengths(conv: DataFrame, turns_col: str = "turns", has_image: Column | None = None) -> DataFrame:
    """O-39: word count over turns; ``length`` adds 128 with an image,
    ``modality_length`` is negative without one."""
    words = F.aggregate(F.transform(turns_col, lambda x: T.word_count(x["value"])), F.lit(0), lambda a, b: a + b)
    img = has_image if has_image is not None else F.lit(False)
    return conv.withColumn("n_words", words.cast("long")).withColumn(
        "length", (F.col("n_words") + F.when(img, F.lit(K.IMAGE_LENGTH_BONUS)).otherwise(F.lit(0))).cast("long")
    ).withColumn("modality_length", F.when(img, F.col("n_words")).otherwise(-F.col("n_words")).cast("long"))
