"""Find and mask personal data in notes, and turn the notes into label rows, on Spark."""

from notemask.operators.gazetteers import Gazetteers, build_gazetteers
from notemask.plans.pipeline import annotate_notes, rejected_notes, tag_notes

__all__ = ["Gazetteers", "annotate_notes", "build_gazetteers", "rejected_notes", "tag_notes"]
