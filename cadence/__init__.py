"""cadence — per-session multi-channel signal analytics as Spark DataFrame jobs.

Frames arrive as binary messages (or table rows); they are decoded, cut into
overlapping sample windows per session, filtered, transformed to spectra,
classified and written to session/result tables.  A batch path turns
recordings plus interval annotations into labelled short-time spectra,
channel-correlation features and a k-means model.

Every public function takes and returns DataFrames (or Columns); nothing is
collected to the driver except bounded model parameters.
"""

from cadence.session import get_spark, scratch_dir

__all__ = ["get_spark", "scratch_dir"]
