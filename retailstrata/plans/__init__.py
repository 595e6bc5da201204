"""The layered pipeline: raw to silver to gold."""
