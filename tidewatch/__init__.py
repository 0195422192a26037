"""tidewatch: daily market analytics as Spark DataFrame jobs.

Raw price, news and macro records go through clean (silver), joined and
featured (gold), labelled (marts), checked (quality) and read (reports)
layers. Every step is a function DataFrame -> DataFrame; nothing runs at
import time and no step collects rows to the driver.
"""

from tidewatch.session import prepare, shared_dir

__all__ = ["prepare", "shared_dir"]
