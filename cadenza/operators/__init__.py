"""cadenza.operators"""
