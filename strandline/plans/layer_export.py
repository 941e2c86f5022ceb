"""Export of one layer: feature numbers, row chunks, and the combined dataset."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from strandline.operators.dictionary import dictionary_encode
from strandline.operators.packing import ROWS_PER_CHUNK
from strandline.sources.datasets import combine_chunks, layer_ingest, write_chunks


@dataclass
class LayerExport:
    chunks: str
    combined: str | None


def export_layer(table: DataFrame, layer: str, output_dir: str, title: str, fid: str | None = None,
                 order_by: list[str] | None = None, chunk_rows: int = ROWS_PER_CHUNK,
                 dictionary: list[str] | None = None) -> LayerExport:
    """Number the features, encode the ``dictionary`` columns (``<column>_code`` beside each), write ``<output>/chunks`` per layer and chunk, then ``<output>/<title>.parquet`` from this layer's chunks.

    Chunks of other layers in the same output stay as they are.
    """
    output_dir = output_dir.rstrip("/")
    chunks, target = f"{output_dir}/chunks", f"{output_dir}/{title}.parquet"
    features = layer_ingest(table, layer, order_by, fid)
    for column in dictionary or []:
        features = dictionary_encode(features, column, f"{column}_code")
    write_chunks(features, chunks, layer, chunk_rows)
    done = combine_chunks(table.sparkSession, chunks, layer, target)
    return LayerExport(chunks, target if done else None)
