"""DataFrame to DataFrame operators over keyed, ranked tables."""
