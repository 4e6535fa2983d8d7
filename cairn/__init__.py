"""Cairn: conformed entities and tested dimensional marts as Spark plans.

Every public function takes and returns DataFrames or Columns, so a whole mart
stays one lazy plan until it is written.
"""

__version__ = "0.1.0"
