"""The layers: silver from landed files, gold from silver, their checks, and the run of all of them."""
