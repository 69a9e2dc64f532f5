"""Loads that go on where the last one stopped."""
