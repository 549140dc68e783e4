"""The model set: staging, dimensions, fact, marts, their checks and the run order."""
