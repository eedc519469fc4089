"""feedloom: recurring policy feeds to typed, historised, latest-state tables on Spark.

Every public function takes and returns DataFrames (or ``Column`` expressions);
run time, batch ids and paths are arguments, never hidden state.
"""
