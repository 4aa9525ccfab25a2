"""Intermediate tables of these operators: those of ``sources.shared``."""

from ..sources.shared import clean, shared_folder, written, written_path

__all__ = ["clean", "shared_folder", "written", "written_path"]
