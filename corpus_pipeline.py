"""A corpus made ready for training, in five stages over ``documents``.

Each stage is written and read again by whoever runs them; all but the last keep the columns
of the table they get.
"""

from pyspark.sql import functions as F

from rateflow.llm import decontamination, jaccard, pii, segmentation, toxicity
from rateflow.llm.queries import PIECES, table
from rateflow.llm.rows import rows_with_ids, unused
from rateflow.operators.joins import broadcast_if_small
from rateflow.session import stage


def drop_toxic(spark, docs, sf_dir):
    """Documents that the class-conditional models do not reject; null and empty texts are scored too."""
    prefix = unused(docs.columns, "toxicity_")
    trained = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, trained, keep_text=True, prefix=prefix)
    return scored.where(f"{prefix}predicted = 0").select(docs.columns)


def one_of_each_group(spark, docs, sf_dir):
    """The document with the smallest id of each group of near-duplicates.

    Rows are judged one by one: of rows that share an id, or have none, only those go that
    are near another row that stays. A row without an id stays after all others of its group.
    """
    rows, own, shared = rows_with_ids(docs)
    grouped = jaccard.jaccard_components(rows)
    if shared is None:
        others = grouped.where("doc_id != component_id").select("doc_id")
    else:
        grouped = grouped.join(broadcast_if_small(shared.withColumn("known", F.lit(True))), "doc_id", "left")
        order = F.when(F.col("known"), F.col("own_id")).otherwise(F.col("doc_id"))
        rank = F.struct(order.isNull().alias("nameless"), order.alias("id"), F.col("doc_id").alias("row"))
        leads = grouped.groupBy("component_id").agg(F.min(rank).alias("lead"))
        others = grouped.join(leads, "component_id").where("doc_id != lead.row").select("doc_id")
    kept = rows.join(broadcast_if_small(stage(others.distinct(), "others")), "doc_id", "left_anti")
    return kept.withColumn("doc_id", F.col(own)).select(docs.columns)


def drop_contaminated(spark, docs, sf_dir):
    """Rows that hold no benchmark item; null and empty texts hold none."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark, docs, sf_dir):
    """The documents with personal data in their texts masked."""
    return pii.mask(docs, pii.train(docs))


def encode(spark, docs, sf_dir):
    """Sampled segmentations of every document, as token ids."""
    sampled = segmentation.encode(docs, PIECES)
    return sampled.select("doc_id", "lang", "source", "sample", "ids", "log_prob", "inclusion")


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", one_of_each_group),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", mask_personal_data),
    ("sentencepiece", encode),
]

# The models are trained on the corpus, which SQL cannot express.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        result = function(spark, docs, sf_dir)
        docs = stage(result, name) if name != STAGES[-1][0] else result
    return docs
