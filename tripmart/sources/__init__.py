"""Tables read and written by the jobs."""
