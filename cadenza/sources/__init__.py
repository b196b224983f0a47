"""cadenza.sources"""
