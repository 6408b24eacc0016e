"""grainmill: tabular preparation, analysis and modelling as Spark DataFrame operators."""
