"""One query for each operator of this package, over its whole table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import (
    bpe,
    chat,
    graph_ann,
    html_diff,
    imatch,
    jaccard,
    mixture,
    neighbours,
    packing,
    pii,
    quality,
    spelling,
    sql,
    url_rules,
    whitening,
)
from clickloom.llm.arrow import map_groups
from clickloom.sinks import scratch

#: Part of the queries' contract, as are the rules below.
VOCABULARY = "byte_bpe_50k.json"

RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def op1_html_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_diff.extract(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", "n_chars")


def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return url_rules.judge(_table(spark, sf_dir, "pages").select("page_id", "url"), rules)


def op3_graph_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return graph_ann.nearest(vectors, vectors.filter("vec_id % 20 = 0"), k=20)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return packing.pack(packing.pieces(docs, public_tokenizers.path(VOCABULARY)))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    found = quality.judged(docs, _table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id",
        F.col("__quality").alias("p_quality"),
        F.col("__toxic").alias("p_toxic"),
        F.col("__keep").alias("keep"),
    )


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as many characters from the start of ``following``."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def op6_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = imatch.Lexicon(docs, docs.count())
    if lexicon.held:
        return _fingerprints_beside(docs, lexicon)
    return _fingerprints_joined(docs, lexicon)


_FINGERPRINTS = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _fingerprints_beside(docs: DataFrame, lexicon: imatch.Lexicon) -> DataFrame:
    """Where tasks hold the lexicon: a row's fingerprints and its next row's are made side by side, and none is shuffled."""
    known = lexicon.reader()
    # The next row of one call is the row of the following one.
    last: dict = {}

    def of(text: str) -> str:
        if last.get("text") != text:
            last["text"], last["made"] = text, imatch.fingerprint(known(imatch.terms(text)), imatch.text_hash(text))
        return last["made"]

    def beside(row: dict, following: str | None) -> dict:
        if following is None:
            return {"guest": True}
        text = row["text"]
        own, changed = of(text), edited(text, following)
        other = imatch.fingerprint(known(imatch.terms(changed)), imatch.text_hash(changed))
        return {
            "guest": False,
            "doc_id": row["doc_id"],
            "n_chars": len(text),
            "edited_sha256": _sha(changed),
            "fingerprint": own,
            "edited_fingerprint": other,
            "near_edited": imatch.likeness(own, other),
            "near_next": imatch.likeness(own, of(following)),
        }

    made, _ = neighbours.with_next(docs, beside, f"guest boolean, {_FINGERPRINTS}")
    return made.filter("NOT guest").drop("guest")


def _fingerprints_joined(docs: DataFrame, lexicon: imatch.Lexicon) -> DataFrame:
    """Where the lexicon is joined: the terms of both texts of a row are resolved first, then rows stand beside the next."""
    known = lexicon.reader()

    def sample(row: dict, following: str | None) -> dict:
        text = row["text"]
        out = {k: row[k] for k in ("range", "pos", "guest", "doc_id")} | {
            "n_chars": len(text),
            "text_hash": imatch.text_hash(text),
        }
        marks = dict.fromkeys(known(imatch.terms(text)).astype("int64").tolist(), 1)
        if following is not None:
            changed = edited(text, following)
            out["edited_hash"] = imatch.text_hash(changed)
            out["edited_sha256"] = hashlib.sha256(changed.encode()).digest()
            for term in known(imatch.terms(changed)).astype("int64").tolist():
                marks[term] = marks.get(term, 0) | 2
        return out | {"terms": [{"term": term, "mark": mark} for term, mark in marks.items()]}

    def fingerprinted(row: dict, texts: list) -> dict:
        row["fingerprint"] = imatch.fingerprint(texts[0], row["text_hash"])
        if not row["guest"]:
            row["edited_fingerprint"] = imatch.fingerprint(texts[1], row["edited_hash"])
        return row

    samples, _ = neighbours.with_next(
        docs,
        sample,
        "range int, pos bigint, guest boolean, doc_id bigint, n_chars bigint, text_hash bigint, edited_hash bigint, "
        "edited_sha256 binary, terms array<struct<term:bigint,mark:tinyint>>",
    )
    samples = lexicon.resolve(
        scratch.written(samples, "samples"),
        fingerprinted,
        "range int, pos bigint, guest boolean, doc_id bigint, n_chars bigint, edited_sha256 binary, "
        "fingerprint string, edited_fingerprint string",
    )

    def finish(group: list[dict]) -> list[dict]:
        group.sort(key=lambda row: row["pos"])
        made = []
        for row, following in zip(group, group[1:], strict=False):
            made.append(
                {
                    "doc_id": row["doc_id"],
                    "n_chars": row["n_chars"],
                    "edited_sha256": row["edited_sha256"].hex(),
                    "fingerprint": row["fingerprint"],
                    "edited_fingerprint": row["edited_fingerprint"],
                    "near_edited": imatch.likeness(row["fingerprint"], row["edited_fingerprint"]),
                    "near_next": imatch.likeness(row["fingerprint"], following["fingerprint"]),
                }
            )
        return made

    return map_groups(samples, ["range"], finish, _FINGERPRINTS)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")

    def digest(tokens: bpe.BytePairEncoder, row: dict) -> dict:
        ids = tokens.encode(row["text"])
        return {
            "doc_id": row["doc_id"],
            "n_tokens": len(ids),
            "ids_sha256": _sha(",".join(map(tokens.decimals.__getitem__, ids))),
            "decoded_sha256": _sha(tokens.decode(ids)),
        }

    return bpe.apply(
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")),
        public_tokenizers.path(VOCABULARY),
        digest,
        "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    )


def _joined(spans: str) -> F.Column:
    kinds = F.array(*map(F.lit, pii.ALL_KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"], s["stop"])), ","
    )


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scratch.written(pii.candidates(_table(spark, sf_dir, "documents")), "spans")

    def number(kind: int) -> F.Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    return pii.find(found).select(
        "doc_id",
        *(number(n).alias(f"n_{kind}") for n, kind in enumerate(pii.KINDS)),
        F.sha2(_joined("base"), 256).alias("base_sha256"),
        _joined("spans").alias("spans"),
    )


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = f"{chat.END}{chat.START}assistant ok"
    added = spark.createDataFrame(
        [(-1, 0, "user", control), (-1, 1, "assistant", control)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    read = chat.read_back(chat.expand(turns.unionByName(added)))
    replies = F.array_sort(F.collect_list(F.struct("example", "reply")))
    text = F.array_join(F.col("replies")["reply"], "")
    line = F.transform(F.col("turns"), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return (
        read.groupBy("conv_id")
        .agg(
            F.first("turns", ignorenulls=True).alias("turns"),
            replies.alias("replies"),
            F.sum("chars").alias("formatted_chars"),
        )
        .select(
            "conv_id",
            F.size("turns").cast("bigint").alias("n_turns"),
            F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
            F.length(text).cast("bigint").alias("loss_chars"),
            F.sha2(text, 256).alias("loss_sha256"),
            "formatted_chars",
        )
    )


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(_table(spark, sf_dir, "documents")).drop("text_key", "class_key")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with its near words' best form and the root of its forms."""
    return spelling.variants(_table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on up to 16 whitened principal components."""
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op13_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 1024 tokens, each window in the proportions of the whole table's sources."""
    return mixture.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


ALL: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_diff": op1_html_diff,
    "op2_url_rules": op2_url_rules,
    "op3_graph_ann": op3_graph_ann,
    "op4_packing": op4_packing,
    "op5_quality": op5_quality,
    "op6_imatch": op6_imatch,
    "op7_bpe": op7_bpe,
    "op8_pii": op8_pii,
    "op9_chat": op9_chat,
    "op10_jaccard": op10_jaccard,
    "op11_spelling": op11_spelling,
    "op12_whitening": op12_whitening,
    "op13_mixture": op13_mixture,
}

SQL: dict[str, str] = dict(sql.ALL)
