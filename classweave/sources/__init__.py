"""Tables, fitted pipelines and staged intermediate tables."""

from classweave.sources.files import recover
from classweave.sources.models import load_model, save_model
from classweave.sources.staging import shared_folder, staged
from classweave.sources.tables import read_csv, read_csv_checked, read_parquet, write_parquet
from classweave.sources.versions import read_version, version_names, write_version

__all__ = [
    "load_model",
    "read_csv",
    "read_csv_checked",
    "read_parquet",
    "read_version",
    "recover",
    "save_model",
    "shared_folder",
    "staged",
    "version_names",
    "write_parquet",
    "write_version",
]
