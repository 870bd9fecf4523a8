"""PIP-3: manifest train split -> training examples.

Batches and the step plan are separate calls on the examples
(``sft.assemble_batches``, ``sft.step_plan``), so asking for one does not
compute the other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from captally.functions.subword import SubwordTokenizer
from captally.operators.captioner import PRESETS
from captally.operators.materialize import cut
from captally.operators.pairing import drop_bad_samples, first_caption
from captally.operators.sft import MAX_LEN, build_vocab, training_examples
from captally.operators.splits import manifest_split

# Fixed value: the training prompt (differs from the adapter-eval prompt, Q17).
TRAINING_PROMPT = PRESETS["zero_shot"].prompt


def training_captions(manifest: DataFrame, image_status: DataFrame | None = None) -> DataFrame:
    """(image, caption): the first caption of each train image that can be used.

    Images without a caption, and those whose ``image_status`` (image, status)
    is not ``ok``, are dropped, as the reference drops samples it cannot build.
    """
    train = manifest_split(manifest, "train").select(F.col("filename").alias("image"), first_caption("refs").alias("caption"))
    train = train.where(F.col("caption").isNotNull())
    if image_status is not None:
        train = drop_bad_samples(train.join(image_status, "image")).drop("status")
    return train


def prepare_training(
    manifest: DataFrame,
    image_status: DataFrame | None = None,
    vocab: DataFrame | None = None,
    prompt: str = TRAINING_PROMPT,
    max_len: int = MAX_LEN,
    mask_eos: bool = True,
    out: str | None = None,
    tokenizer: SubwordTokenizer | None = None,
) -> DataFrame:
    """PIP-3: training examples from a manifest (filename, split, refs); written to ``out`` as Parquet if given.

    Ids come from ``tokenizer``, or from ``vocab``, or from a vocabulary of the captions' own words.
    """
    captions = cut(training_captions(manifest, image_status), "training-captions")
    if vocab is None and tokenizer is None:
        vocab = build_vocab(captions)
    examples = training_examples(captions, prompt, vocab, max_len, mask_eos=mask_eos, tokenizer=tokenizer)
    if out is None:
        return examples
    examples.write.mode("overwrite").parquet(out)
    return captions.sparkSession.read.parquet(out)
