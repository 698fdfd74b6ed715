"""The healthcare pipeline, its reports, and the stand-in inputs."""
