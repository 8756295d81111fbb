"""Nothing here yet: loads read bounded rowsets, and have no watermarks, windows over time, or state."""
