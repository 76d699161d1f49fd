"""Reports as streams that go on where they were broken off."""
