"""Model outputs as files: predictions, metrics, clustered films, cluster summary, fitted pipelines."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from marquee.sinks.files import write_csv


def write_classifier(model: PipelineModel, predictions: DataFrame, base_path: str) -> dict[str, str]:
    """The test rows' predictions as CSV and the fitted pipeline; returns the paths by name."""
    base = base_path.rstrip("/")
    model.write().overwrite().save(f"{base}/modelo_clasificador")
    return {"predicciones": write_csv(predictions, f"{base}/predicciones"),
            "modelo_clasificador": f"{base}/modelo_clasificador"}


def write_segmentation(model: PipelineModel, metrics: DataFrame, clustered: DataFrame, summary: DataFrame,
                       base_path: str) -> dict[str, str]:
    """Metrics per k, films with cluster and segment, and the cluster summary as CSV, and the pipeline."""
    base = base_path.rstrip("/")
    model.write().overwrite().save(f"{base}/modelo_segmentacion")
    return {"metricas": write_csv(metrics, f"{base}/metricas"),
            "resultados": write_csv(clustered, f"{base}/resultados"),
            "resumen": write_csv(summary, f"{base}/resumen"),
            "modelo_segmentacion": f"{base}/modelo_segmentacion"}
