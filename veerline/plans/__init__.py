from .detection import Detection, detect
from .incremental import baseline_of_days, refresh_days, rolling_scores, stored_days
from .run import covered_by, run_detection, run_training
from .training import Training, train

__all__ = [
    "baseline_of_days", "refresh_days", "rolling_scores", "stored_days",
   "Detection", "Training", "covered_by", "detect", "run_detection", "run_training", "train"]
