"""roadsight: road-violation analytics as Spark DataFrame plans.

Vehicle detections become speeding and wrong-way violations through window
functions and keyed state; the violation fact is cleaned, filtered and rolled up
into time, type, location and grid summaries, K-Means zones, key figures and
exports.  Everything is a lazy DataFrame; callers decide the action.
"""

__version__ = "0.1.0"
