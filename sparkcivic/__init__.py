"""sparkcivic: DataFrame operators for incident, site and census-style tables.

Every public function takes and returns lazy Spark objects (Column or
DataFrame); nothing is collected unless a function says so explicitly.
"""

__version__ = "0.1.0"
